"""The command-line jobs on text files in the original layouts."""

import os

from hopscope.cli import run


def write_lines(path, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-00000"), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def read_lines(spark, path):
    return sorted(r.value for r in spark.read.text(path).collect())


TOY = ["1\t2,3", "2\t4", "3\t4,7", "4\t5", "5\t1,6", "8\t1,9"]


def test_adjacency_job(spark, scratch):
    edges = os.path.join(scratch, "edges")
    write_lines(edges, ["1,2", "1,3", "1,2", "2,5", "3,1", "4,4", "5,1", "bad"])
    out = os.path.join(scratch, "adj")
    run(spark, ["adjacency", edges, out, "5", "--n", "5", "--start", "1"])
    # every id of 1..5 is drawn when k = n
    assert read_lines(spark, out) == ["1\t2,2,3", "2\t5", "3\t1", "4\t4", "5\t1"]


def test_paths_job_two_sources(spark, scratch):
    adj = os.path.join(scratch, "adj")
    write_lines(adj, TOY)
    out = os.path.join(scratch, "out")
    run(spark, ["paths", adj, out, "1", "4", "--absorbing"])
    assert read_lines(spark, os.path.join(out, "lsp")) == ["1\t2", "4\t2"]
    assert read_lines(spark, os.path.join(out, "rounds")) == ["1\t3", "2\t4", "3\t0"]
    state = read_lines(spark, os.path.join(out, "state"))
    assert "5to1\t1,6 2147483647" in state and "7to1\tnull 2" in state and "1to4\tnull 2" in state
    # resume from that state gives the same answer
    out2 = os.path.join(scratch, "out2")
    run(spark, ["resume", adj, os.path.join(out, "state"), out2, "1", "4", "--absorbing"])
    assert read_lines(spark, os.path.join(out2, "lsp")) == ["1\t2", "4\t2"]


def test_bounded_job(spark, scratch):
    adj = os.path.join(scratch, "adj")
    write_lines(adj, TOY)
    out = os.path.join(scratch, "out")
    run(spark, ["bounded", adj, out, "6"])
    assert read_lines(spark, os.path.join(out, "lsp")) == ["4"]
    d = read_lines(spark, os.path.join(out, "distances"))
    assert "(8,2147483647)" in d and "(5,1)" in d and len(d) == 9
