"""Bit-parallel traversals against the row form."""

import random

import pytest
from pyspark.sql import functions as F

import hopscope as hs
from hopscope.operators.bitsets import _new_bits, bit_paths
from hopscope.plans.session import iteration_settings, scoped_conf
from tests.conftest import edges_df, rows
from tests.test_plans import plan_text
from tests.test_properties import bfs, random_graph


def lsp(df):
    return {r["source"]: r["lsp"] for r in df.collect()}


@pytest.mark.parametrize("absorbing", [False, True])
def test_a_thousand_sources(spark, absorbing):
    rnd = random.Random(8)
    e = sorted({(rnd.randrange(1200), rnd.randrange(1200)) for _ in range(1500)} | {(i, i + 1) for i in range(1150, 1180)})
    g = hs.prepare_graph(edges_df(spark, e), partitions=4)
    srcs = [str(i) for i in range(1000)] + ["nowhere", "7"]
    t = bit_paths(g, srcs, stop_at_other_sources=absorbing)
    assert rows(t.distances) == bfs(e, list(dict.fromkeys(srcs)), absorbing=absorbing) and t.converged
    assert t.numbered.count() == 1000 and t.numbered.select("word").distinct().count() == 16
    assert lsp(t.longest()) == lsp(hs.longest_shortest_path(t.distances))


@pytest.mark.parametrize("seed", [1, 2])
def test_rounds_are_those_of_the_row_form(spark, seed):
    e = random_graph(seed, n=60, m=90, hubs=1)
    g = hs.prepare_graph(edges_df(spark, e), chunk=5, partitions=5)
    assert g.hot is not None
    srcs = spark.createDataFrame([(str(i),) for i in range(0, 60, 2)] + [("4",), (None,)], "source string")
    by_row, by_bit = hs.shortest_paths(g, srcs, seed_sinks=True), bit_paths(g, srcs, seed_sinks=True)
    assert by_bit.stats == by_row.stats and rows(by_bit.distances) == rows(by_row.distances)
    cut = bit_paths(g, srcs, max_rounds=2)
    assert not cut.converged and rows(cut.distances) == rows(hs.shortest_paths(g, srcs, max_rounds=2).distances)


def test_state_has_a_row_for_64_sources_and_stays_in_place(spark):
    e = [(i, 500) for i in range(130)] + [(500, i) for i in range(130)]
    g = hs.prepare_graph(edges_df(spark, e), partitions=2)
    t = bit_paths(g, [str(i) for i in range(130)])
    hub = [df.where(F.col("vertex") == 500).count() for df, _ in t.rounds]
    assert hub == [0, 3, 0] and t.stats == [(1, 130), (2, 130 * 129), (3, 0)]
    for df, _ in t.rounds:
        assert df._jdf.queryExecution().executedPlan().outputPartitioning().toString().startswith("hashpartitioning(word")
    cand = t.rounds[1][0].groupBy("word", "vertex").agg(F.bit_or("bits").alias("bits"))
    with scoped_conf(spark, iteration_settings(g.partitions)):
        plan = plan_text(_new_bits(cand, [df for df, _ in t.rounds]))
    assert "Exchange" not in plan, plan


def test_deep_graphs_merge_layers(spark):
    e = [(i, i + 1) for i in range(30)] + [(100 + i, 101 + i) for i in range(5)]
    g = hs.prepare_graph(edges_df(spark, e), partitions=1)
    t = bit_paths(g, ["0", "3", "100"], compact_every=3)
    assert rows(t.distances) == bfs(e, ["0", "3", "100"])
    assert rows(bit_paths(g, ["nowhere"]).distances) == []
