"""Bottom-up rounds: the same rows, chosen by counted edges, with fewer candidates."""

import pytest
from pyspark.sql import functions as F

import hopscope as hs
import hopscope.operators.bottom_up as bu
from hopscope.plans.graph import prepare_graph
from hopscope.sources.tables import part_next
from tests.conftest import edges_df, rows
from tests.test_properties import bfs, random_graph

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("case", ["plain", "named", "salted", "shuffled", "probes"])
def test_bottom_up_rounds_give_the_same_rows(spark, monkeypatch, case):
    e = [(f"v{a}", f"v{b}") if case == "named" else (a, b) for a, b in random_graph(7, n=60, m=700, hubs=2)]
    srcs = [e[0][0], e[-1][0], e[9][0], "nowhere"]
    monkeypatch.setattr(bu, "PROBE", 1 if case == "probes" else 4)
    monkeypatch.setattr(bu.BottomUp, "pays", lambda self: len(self.rounds) % 3 != 0)
    g = prepare_graph(edges_df(spark, e), partitions=4, chunk=8 if case in ("salted", "shuffled") else None)
    if case in ("salted", "shuffled"):
        assert g.hot is not None and g.reversed().hot is not None
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if case == "shuffled":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for absorbing in (False, True):
            t = hs.shortest_paths(g, srcs, stop_at_other_sources=absorbing, bottom_up=True)
            assert rows(t.distances) == bfs(e, srcs, absorbing=absorbing)
            assert t.stats == hs.shortest_paths(g, srcs, stop_at_other_sources=absorbing).stats
            assert {d for _, d, _ in t.directions} == {"down", "up"}
        assert rows(hs.bounded_relaxation(g, srcs[:1], rounds=2, bottom_up=True).distances) == bfs(e, srcs[:1], seeds_at_in_neighbours=True, max_rounds=2)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        g.unpersist()


def test_dense_rounds_go_up_with_fewer_candidates(spark):
    g = prepare_graph(part_next(spark, SF, ids="long"))
    t = hs.shortest_paths(g, ["0", "1"], bottom_up=True)
    plain = hs.shortest_paths(g, ["0", "1"])
    assert rows(t.distances) == rows(plain.distances) and t.stats == plain.stats
    assert t.directions[0][1] == "down" and "up" in [d for _, d, _ in t.directions]
    # A round that goes down makes a candidate of each edge that leaves its frontier.
    outs = g.degrees().select(F.col("vertex").cast("string").alias("vertex"), "outs")
    leaving = dict(t.distances.join(outs, "vertex").groupBy("dist").agg(F.sum("outs")).collect())
    for rnd, direction, candidates in t.directions:
        assert candidates == leaving[rnd - 1] if direction == "down" else candidates < leaving[rnd - 1]
    assert sum(c for _, _, c in t.directions) < 0.7 * sum(leaving.values())
    g.unpersist()


def test_a_sparse_graph_stays_top_down_and_frames_are_refused(spark):
    g = prepare_graph(edges_df(spark, [(i, i + 1) for i in range(12)]))
    t = hs.shortest_paths(g, ["3"], bottom_up=True)
    assert rows(t.distances) == sorted(("3", str(i), i - 3) for i in range(3, 13))
    assert {d for _, d, _ in t.directions[:-2]} == {"down"}
    assert hs.shortest_paths(g, ["nowhere"], bottom_up=True).distances.count() == 0
    with pytest.raises(ValueError):
        hs.shortest_paths(g, spark.createDataFrame([("3",)], "source string"), bottom_up=True)
    g.unpersist()
