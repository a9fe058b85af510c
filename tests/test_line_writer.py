"""One line a vertex, in files that a commit puts in place."""

import os

import pytest
from pyspark.sql import functions as F

import hopscope as hs
from hopscope.cli import run
from hopscope.sources.line_writer import LineWriter
from tests.conftest import edges_df
from tests.test_cli import TOY, read_lines, write_lines


def test_a_hub_of_many_parts_is_one_line(spark, scratch):
    e = [("hub", f"n{i:05d}") for i in range(25_000)] + [("hub", "n00007")] * 3 + [("b", "x"), ("c", "y")]
    adj = hs.to_adjacency(edges_df(spark, e))
    assert adj.where("vertex = 'hub'").count() == 3
    path = f"{scratch}/adj"
    for _ in range(2):  # the second time over what is there
        hs.write_adjacency_lines(adj, path)
        want = [f"{v}\t" + ",".join(sorted(b for a, b in e if a == v)) for v in ("b", "c", "hub")]
        assert read_lines(spark, path) == want
    assert sorted(os.listdir(path))[0] == "_SUCCESS" and not any(n.startswith("_staged") for n in os.listdir(path))
    back = hs.read_adjacency(spark, path)
    assert sorted(map(tuple, hs.to_edges(back).collect())) == sorted(e)


def test_a_job_that_breaks_off_leaves_what_was_there(spark, scratch):
    adj = hs.to_adjacency(edges_df(spark, [("a", "b")]))
    path = f"{scratch}/adj"
    hs.write_adjacency_lines(adj, path)
    broken = adj.withColumn("neighbors", F.expr("transform(neighbors, x -> raise_error('stopped'))"))
    with pytest.raises(Exception, match="stopped"):
        hs.write_adjacency_lines(broken, path)
    assert read_lines(spark, path) == ["a\tb"]
    hs.write_adjacency_lines(adj.limit(0), f"{scratch}/none")
    assert read_lines(spark, f"{scratch}/none") == []


def test_lines_of_a_task(tmp_path):
    from pyspark.sql import Row

    writer = LineWriter(str(tmp_path / "out"), overwrite=True)
    rows = [Row(vertex="a", part=0, neighbors=["x", "y"]), Row(vertex="a", part=1, neighbors=["z"]), Row(vertex="b", part=0, neighbors=["é"])]
    told = [writer.write(iter(rows)), writer.write(iter([]))]
    writer.commit(told)
    files = [n for n in os.listdir(tmp_path / "out") if n.startswith("part")]
    assert len(files) == 1 and (tmp_path / "out" / files[0]).read_text() == "a\tx,y,z\nb\té\n"


def test_logged_jobs(spark, scratch):
    adj, log = f"{scratch}/adj", f"{scratch}/log"
    write_lines(adj, TOY)
    run(spark, ["paths", adj, f"{scratch}/one", "1", "4", "--absorbing", "--max-rounds", "1", "--log", log])
    run(spark, ["continue", adj, log, f"{scratch}/two"])
    run(spark, ["summary", log, f"{scratch}/three"])
    for out in ("two", "three"):
        assert read_lines(spark, f"{scratch}/{out}/lsp") == ["1\t2", "4\t2"]
    assert read_lines(spark, f"{scratch}/two/rounds") == ["1\t3", "2\t4", "3\t0"]
