"""One vertex holding a large share of all edges, with default settings."""

from pyspark.sql import functions as F

import hopscope as hs
from tests.conftest import edges_df, rows
from tests.test_properties import bfs


def skewed_edges(n=5):
    hub_out = [(0, v) for v in range(1, 30_001)]          # half of all edges leave vertex 0
    hub_in = [(v, 7) for v in range(1, 20_001)]            # a third of all edges enter vertex 7
    chain = [(v, v + 1) for v in range(30_001, 30_001 + n)]
    bridge = [(5, 30_001), (30_001 + n, 0)]
    return hub_out + hub_in + chain + bridge


def test_hub_is_split_and_results_exact(spark):
    e = skewed_edges()
    g = hs.prepare_graph(edges_df(spark, e), partitions=4)
    assert g.hot is not None
    hot = {r.hot_vertex: r.nsalt for r in g.hot.collect()}
    assert list(hot) == [0] and hot[0] >= 2
    # no (vertex, salt) group holds much more than the chunk (targets are
    # hashed into the salts, so a group is about chunk-sized)
    biggest = g.edges.groupBy("src", "salt").count().agg(F.max("count")).first()[0]
    assert biggest <= 1.1 * g.chunk
    # the hub is spread: several partitions hold its edges, none holds them all
    per_part = g.edges.rdd.glom().map(lambda rs: sum(1 for r in rs if r.src == 0)).collect()
    assert sum(1 for x in per_part if x) >= 2 and max(per_part) < 30_000
    srcs = ["30001", "5"]
    assert rows(hs.shortest_paths(g, srcs).distances) == bfs(e, srcs)
    assert rows(hs.bounded_relaxation(g, ["7"], rounds=3).distances) == bfs(
        e, ["7"], seeds_at_in_neighbours=True, max_rounds=3
    )


def test_a_vertex_that_many_sources_reach_is_split(spark, monkeypatch):
    import hopscope.operators.traversal as tr

    monkeypatch.setattr(tr, "WORK_CHUNK", 40_000)
    hub = [(i, 0) for i in range(1, 2001)] + [(0, 10_000 + v) for v in range(2000)] + [(10_000, 20_000), (20_000, 1)]
    g = hs.prepare_graph(edges_df(spark, hub), partitions=8, chunk=700)
    with tr.scoped_conf(spark, tr.iteration_settings(8)):
        frontier, n = tr.materialize(spark.createDataFrame([(i, 0, 1) for i in range(1, 2001)] + [(5, 10_000, 2)], "source long, vertex long, dist int"))
        cand = tr.expand(g, frontier, n, clean=True, sources=2000)
        per_task = [r["count"] for r in cand.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 2000 * 2000 + 1
    assert max(per_task) <= 2 * sum(per_task) / 8  # no task makes over twice the mean
    srcs = [str(i) for i in range(1, 301)]
    monkeypatch.setattr(tr, "WORK_CHUNK", 30_000)
    few = [(a, b) for a, b in hub if b < 10_300]
    got = hs.shortest_paths(hs.prepare_graph(edges_df(spark, few), partitions=4, chunk=100), srcs)
    assert rows(got.distances) == bfs(few, srcs)


def test_hub_adjacency_rows_are_bounded(spark):
    e = skewed_edges()
    adj = hs.to_adjacency(edges_df(spark, e), partitions=4)
    lens = {}
    for r in adj.collect():
        lens.setdefault(r.vertex, []).append(len(r.neighbors))
    assert len(lens["0"]) >= 2 and sum(lens["0"]) == 30_000
    assert max(max(v) for v in lens.values()) <= 20_000
    back = rows(hs.to_edges(adj), ("src", "dst"))
    assert back == sorted((str(a), str(b)) for a, b in e)
