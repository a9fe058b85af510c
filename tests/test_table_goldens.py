"""Published values for the graphs derived from the driver tables
(FIXTURES.md §7): graph sizes, sampled subgraph sizes and traversal
summaries (reached, longest, sum of distances)."""

import os

import pytest
from pyspark.sql import functions as F

import hopscope as hs
from hopscope.sources.tables import part_next, part_next_r

ROOT = "/root/testdata"
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="driver tables not present")

# sf, graph, vertices, keys, sinks, edges, max out-degree, induced edges, induced keys
SIZES = [
    ("0.001", "part_next", 200, 200, 0, 2_736, 25, 152, 47),
    ("0.001", "part_next_r", 139, 93, 46, 142, 4, 8, 8),
    ("0.01", "part_next", 2_000, 2_000, 0, 29_074, 38, 1_870, 491),
    ("0.01", "part_next_r", 1_575, 1_093, 482, 1_730, 6, 109, 97),
]

GRAPHS = {"part_next": part_next, "part_next_r": part_next_r}


def summary(t):
    return {
        r.source: (r.reached, r.lsp, r.total)
        for r in t.distances.groupBy("source")
        .agg(F.count(F.lit(1)).alias("reached"), F.max("dist").alias("lsp"), F.sum("dist").alias("total"))
        .collect()
    }


@pytest.mark.parametrize("sf,name,v,keys,sinks,m,maxdeg,ie,ik", SIZES)
def test_graph_sizes(spark, sf, name, v, keys, sinks, m, maxdeg, ie, ik):
    d = f"{ROOT}/sf{sf}"
    g = hs.prepare_graph(GRAPHS[name](spark, d))
    assert (g.num_edges, g.max_out_degree) == (m, maxdeg)
    assert g.vertices().count() == v
    assert g.keys().count() == keys
    assert v - keys == sinks
    n = spark.read.parquet(f"{d}/part.parquet").count()
    sub = hs.prepare_graph(hs.sampled_subgraph(GRAPHS[name](spark, d), n // 4, n, start=0))
    assert (sub.num_edges, sub.keys().count()) == (ie, ik)


def test_sf0001_traversals(spark):
    d = f"{ROOT}/sf0.001"
    dense = hs.prepare_graph(part_next(spark, d))
    assert summary(hs.shortest_paths(dense, ["0", "1"])) == {"0": (200, 3, 443), "1": (200, 3, 437)}
    sparse = hs.prepare_graph(part_next_r(spark, d))
    assert summary(hs.shortest_paths(sparse, ["7"])) == {"7": (15, 6, 50)}


def test_sf001_traversals(spark):
    d = f"{ROOT}/sf0.01"
    dense = hs.prepare_graph(part_next(spark, d))
    assert summary(hs.shortest_paths(dense, ["0", "1"])) == {"0": (2_000, 4, 6_203), "1": (2_000, 5, 6_201)}
    sparse = hs.prepare_graph(part_next_r(spark, d))
    assert summary(hs.shortest_paths(sparse, ["4"])) == {"4": (73, 18, 782)}
    assert summary(hs.shortest_paths(sparse, ["883", "303"])) == {"883": (188, 18, 1_780), "303": (78, 17, 717)}
    absorbing = hs.shortest_paths(sparse, ["883", "303"], stop_at_other_sources=True)
    assert summary(absorbing) == {"883": (173, 24, 2_013), "303": (78, 17, 717)}
    assert summary(hs.bounded_relaxation(sparse, ["1848"], rounds=20)) == {"1848": (156, 21, 1_932)}
    assert summary(hs.bounded_relaxation(sparse, ["1848"], rounds=100)) == {"1848": (174, 26, 2_354)}


def test_sf01_traversals(spark):
    d = f"{ROOT}/sf0.1"
    dense = hs.prepare_graph(part_next(spark, d))
    assert (dense.num_edges, dense.max_out_degree) == (293_790, 38)
    assert summary(hs.shortest_paths(dense, ["0", "1"])) == {"0": (20_000, 6, 84_659), "1": (20_000, 6, 80_596)}
