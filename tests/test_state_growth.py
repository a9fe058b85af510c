"""Partitions of traversal state follow the rows that are counted."""

import pytest

import hopscope as hs
import hopscope.plans.graph as gr
from hopscope.operators.bitsets import bit_paths
from tests.conftest import edges_df, rows
from tests.test_properties import bfs


def frame(spark, ids):
    return spark.createDataFrame([(str(i),) for i in ids], "source string")


@pytest.mark.parametrize("paths", [hs.shortest_paths, bit_paths])
def test_many_sources_that_reach_little_need_few_partitions(spark, monkeypatch, paths):
    monkeypatch.setattr(gr, "MAX_STATE_ROWS_PER_PARTITION", 2000)
    monkeypatch.setattr(gr, "FEW_SOURCES", 0)
    e = [(10 * c + i, 10 * c + i + 1) for c in range(100) for i in range(9)]
    g = hs.prepare_graph(edges_df(spark, e), partitions=2)
    srcs = range(0, 1000, 5)
    assert g.state_partitions(len(srcs)) > 50
    t = paths(g, frame(spark, srcs), stop_at_other_sources=True)
    kept = [df for df, _ in t.rounds] if paths is bit_paths else t.layers
    assert {df.rdd.getNumPartitions() for df in kept} == {2}
    assert rows(t.distances) == bfs(e, [str(i) for i in srcs], absorbing=True)


@pytest.mark.parametrize("paths", [hs.shortest_paths, bit_paths])
def test_state_that_grows_is_dealt_anew(spark, monkeypatch, paths):
    monkeypatch.setattr(gr, "MAX_STATE_ROWS_PER_PARTITION", 100)
    monkeypatch.setattr(gr, "FEW_SOURCES", 0)
    e = [(i, (i * 2 + d) % 64) for i in range(64) for d in (0, 1)] + [(64 + i, 0) for i in range(8)]
    g = hs.prepare_graph(edges_df(spark, e), partitions=1)
    srcs = [0, 3, 64, 65, 66, *range(10, 40)]
    t = paths(g, frame(spark, srcs))
    kept = t.rounds[-1][0] if paths is bit_paths else t.layers[-1]
    held = len(srcs) * 64 if paths is not bit_paths else 64
    assert kept.rdd.getNumPartitions() >= held // 100
    assert rows(t.distances) == bfs(e, [str(i) for i in srcs]) and t.converged
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
