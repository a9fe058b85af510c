"""Adjacency parts, state keys, resumed sources, short csv rows."""

import os

import pytest

import hopscope as hs
from tests.conftest import edges_df, rows


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_parts_do_not_depend_on_partitions(spark, partitions):
    e = [("hub", f"n{i:03d}") for i in range(50)] + [("hub", "n007")] * 30 + [("b", "x"), ("b", "a")]
    got = {(r["vertex"], r["part"]): r["neighbors"] for r in hs.to_adjacency(edges_df(spark, e), max_list=16, partitions=partitions).collect()}
    want = sorted(d for s, d in e if s == "hub")
    assert got == {("b", 0): ["a", "x"], **{("hub", i): want[16 * i : 16 * i + 16] for i in range(5)}}


def test_state_keys_with_the_separator(spark):
    lines = spark.createDataFrame([("toledototoledo\tnull 0",), ("xtoytotoledo\tnull,a 1",), ("nulltoother\tb 2",)], "value string")
    got = [(r["source"], r["vertex"], r["neighbors"], r["dist"]) for r in hs.parse_state_lines(lines, sources=["toledo"]).collect()]
    assert got == [("toledo", "toledo", [], 0), ("toledo", "xtoy", ["null", "a"], 1)]
    with pytest.raises(Exception, match="ends in two"):
        hs.parse_state_lines(lines, sources=["toledo", "toledototoledo", "ledo", "other", "ytotoledo"]).collect()


def test_resume_keeps_to_its_sources(spark):
    g = hs.prepare_graph(edges_df(spark, [(1, 2), (2, 3), (3, 4)]))
    state = spark.createDataFrame([("1", "1", 0), ("3", "3", 0)], "source string, vertex string, dist int")
    assert rows(hs.resume_shortest_paths(g, state, sources=["1"]).distances) == [("1", "1", 0), ("1", "2", 1), ("1", "3", 2), ("1", "4", 3)]


def test_csv_edges_skip_short_rows(spark, scratch):
    path = os.path.join(scratch, "e.csv")
    with open(path, "w") as f:
        f.write("a\na,b\nb,c,d\n\n,x\n")
    assert sorted(map(tuple, hs.read_edges(spark, path, fmt="csv").collect())) == [("a", "b"), ("b", "c")]


@pytest.mark.parametrize("numeric", [None, False])
def test_the_form_of_ids_does_not_show(spark, numeric):
    g = hs.prepare_graph(edges_df(spark, [(1, 2), (2, 3)]), numeric_ids=numeric)
    srcs = ["1", "abc", "007", "3"]
    want = sorted([("1", "1", 0), ("1", "2", 1), ("1", "3", 2), *((s, s, 0) for s in srcs[1:])])
    assert rows(hs.shortest_paths(g, srcs, seed_sinks=True).distances) == want
    assert rows(hs.seed_from_sources(g, srcs, seed_sinks=True)) == sorted((s, s, 0) for s in srcs)
    assert rows(hs.shortest_paths(g, srcs).distances) == [r for r in want if r[0] == "1"]
    state = spark.createDataFrame([("1", "1", 0), ("1", "007", 4), ("1", "007", 3), ("x", "2", 1), ("x", "9", None)], "source string, vertex string, dist int")
    assert rows(hs.resume_shortest_paths(g, state).distances) == sorted([("1", "1", 0), ("1", "2", 1), ("1", "3", 2), ("1", "007", 3), ("x", "2", 1), ("x", "3", 2)])


def test_parts_and_records_in_files(spark, scratch):
    adj = hs.to_adjacency(edges_df(spark, [("h", f"n{i}") for i in range(5)]), max_list=2)
    hs.write_adjacency(adj, f"{scratch}/a", fmt="parquet")
    assert sorted(r["part"] for r in spark.read.parquet(f"{scratch}/a").collect()) == [0, 1, 2]
    d = spark.createDataFrame([("1", "2", 3), ("1", "4", None)], "source string, vertex string, dist int")
    hs.write_distances(d, f"{scratch}/d", fmt="text", with_source=False, record=True)
    assert sorted(r[0] for r in spark.read.text(f"{scratch}/d").collect()) == ["Distance(2,3)", "Distance(4,2147483647)"]
