"""Readers and writers: layouts, malformed lines, round trips."""

import os

import hopscope as hs
from hopscope.sources.sinks import adjacency_lines, distance_lines, state_lines, summary_lines
from tests.conftest import edges_df, rows


def lines(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], "value string")


def test_edge_lines(spark):
    df = lines(spark, ["1,2", "3,4,extra", "5", "6,7,", ""])
    assert rows(hs.parse_edge_lines(df), ("src", "dst")) == [("1", "2"), ("3", "4"), ("6", "7")]
    assert hs.count_malformed_edge_lines(df).first().malformed == 2


def test_adjacency_lines(spark):
    df = lines(spark, ["a\tb,", "a\tc", "x", "x\t", "y  p,q,r  ", "z\tnull"])
    got = {(r.vertex, tuple(r.neighbors)) for r in hs.parse_adjacency_lines(df).collect()}
    assert got == {("a", ("b",)), ("a", ("c",)), ("y", ("p", "q", "r")), ("z", ("null",))}
    assert hs.count_malformed_adjacency_lines(df).first().malformed == 2
    # two rows of one vertex contribute the union of their lists
    e = rows(hs.to_edges(hs.parse_adjacency_lines(df)), ("src", "dst"))
    assert ("a", "b") in e and ("a", "c") in e


def test_state_lines_both_layouts(spark):
    multi = lines(spark, ["1to9\t2,3 0", "2to9\tnull 2147483647", "4to9\t5 2", "bad"])
    got = rows(hs.parse_state_lines(multi))
    assert got == [("9", "1", 0), ("9", "2", None), ("9", "4", 2)]
    single = lines(spark, ["1\t2,3 0", "7\tnull 4"])
    assert rows(hs.parse_state_lines(single, source="1")) == [("1", "1", 0), ("1", "7", 4)]


def test_adjacency_round_trip(spark, scratch):
    e = edges_df(spark, [(1, 2), (1, 3), (1, 2), (3, 1), (4, 4)])
    adj = hs.to_adjacency(e)
    path = os.path.join(scratch, "adj")
    hs.write_adjacency(adj, path)
    back = hs.read_adjacency(spark, path)
    assert sorted((r.vertex, tuple(r.neighbors)) for r in back.collect()) == [
        ("1", ("2", "2", "3")), ("3", ("1",)), ("4", ("4",))
    ]
    assert rows(adjacency_lines(adj), ("value",)) == [("1\t2,2,3",), ("3\t1",), ("4\t4",)]


def test_edge_formats(spark, scratch):
    e = edges_df(spark, [(1, 2), (2, 3)])
    for fmt in ("text", "csv", "parquet"):
        path = os.path.join(scratch, fmt)
        if fmt == "text":
            e.selectExpr("concat_ws(',', src, dst) AS value").write.text(path)
        elif fmt == "csv":
            e.write.csv(path)
        else:
            e.write.parquet(path)
        assert rows(hs.read_edges(spark, path, fmt=fmt), ("src", "dst")) == [("1", "2"), ("2", "3")]


def test_state_round_trip_and_resume(spark, scratch):
    g = hs.prepare_graph(edges_df(spark, [(1, 2), (2, 3), (3, 4), (4, 1), (2, 5)]))
    partial = hs.shortest_paths(g, ["1", "3"], max_rounds=1)
    full = rows(hs.shortest_paths(g, ["1", "3"]).distances)
    pq = os.path.join(scratch, "state_pq")
    hs.write_state(partial.distances, pq)
    assert rows(hs.resume_shortest_paths(g, hs.read_state(spark, pq)).distances) == full
    txt = os.path.join(scratch, "state_txt")
    hs.write_state(partial.with_unreached(), txt, fmt="text", adjacency=hs.to_adjacency(g.edge_pairs()))
    state = hs.read_state(spark, txt, fmt="text")
    assert rows(hs.resume_shortest_paths(g, state, sources=["1", "3"]).distances) == full


def test_distance_and_summary_lines(spark, scratch):
    d = spark.createDataFrame([("s", "a", 1), ("s", "b", None)], "source string, vertex string, dist int")
    assert rows(distance_lines(d), ("value",)) == [("(s,a,1)",), ("(s,b,2147483647)",)]
    assert rows(distance_lines(d, with_source=False), ("value",)) == [("(a,1)",), ("(b,2147483647)",)]
    adj = spark.createDataFrame([("a", ["b"])], "vertex string, neighbors array<string>")
    assert rows(state_lines(d, adj), ("value",)) == [("atos\tb 1",), ("btos\tnull 2147483647",)]
    lsp = hs.longest_shortest_path(d)
    assert rows(summary_lines(lsp), ("value",)) == [("s\t1",)]
    path = os.path.join(scratch, "lsp")
    hs.write_summary(lsp, path)
    hs.write_summary(lsp, path)  # overwrite by default
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["s\t1"]
    hs.write_distances(d, os.path.join(scratch, "dist"), fmt="text")
