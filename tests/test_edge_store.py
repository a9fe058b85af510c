"""The bucketed edge store: pruned rounds, hubs over files, transposed side, broken writes."""

import os

import pytest
from pyspark.sql import functions as F

import hopscope as hs
import hopscope.operators.traversal as tr
from hopscope.plans.edge_store import bitmap_columns, bucket_of, buckets_in, open_edge_store, open_graph, write_edge_store
from hopscope.plans.files import Folder
from hopscope.plans.session import iteration_settings, scoped_conf
from tests.conftest import edges_df, rows
from tests.test_plans import plan_text
from tests.test_properties import bfs, random_graph


@pytest.mark.parametrize("named", [False, True])
def test_stored_graph_gives_the_same_rows(spark, scratch, named):
    e = [(f"v{a}", f"v{b}") if named else (a, b) for a, b in random_graph(5, n=80, m=150)]
    srcs = [e[0][0], e[-1][0], "nowhere"]
    store = write_edge_store(edges_df(spark, e + e[:9]), f"{scratch}/g", buckets=64)
    assert store.id_type == ("string" if named else "long") and store.num_edges == len(set(e))
    g = open_graph(spark, f"{scratch}/g")
    assert rows(hs.shortest_paths(g, srcs).distances) == bfs(e, srcs)
    assert rows(hs.shortest_paths(g, srcs, stop_at_other_sources=True).distances) == bfs(e, [str(s) for s in srcs], absorbing=True)
    assert rows(hs.bounded_relaxation(g, [e[3][1]], rounds=3).distances) == bfs(e, [e[3][1]], seeds_at_in_neighbours=True, max_rounds=3)
    assert rows(hs.seed_from_sources(g, srcs)) == sorted((str(s), str(s), 0) for s in srcs[:2])


def test_small_frontier_reads_only_its_buckets(spark, scratch):
    e = [(i, (i * 7 + j) % 4000) for i in range(4000) for j in range(3)]
    write_edge_store(edges_df(spark, e), f"{scratch}/g", buckets=256)
    g = open_graph(spark, f"{scratch}/g")
    frontier = spark.createDataFrame([(1, i * 17, 0) for i in range(10)], "source long, vertex long, dist int")
    near = g.store.touched(frontier, "vertex")
    assert 1 < len(near) <= 10
    with scoped_conf(spark, iteration_settings(g.partitions)):
        cand = tr.expand(g, frontier, 10, clean=True, buckets=near)
        plan = plan_text(cand)
    assert "PartitionFilters: [bucket" in plan and "InMemoryTableScan" not in plan and "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    files = [g.store.scan("out", b).select(F.input_file_name()).distinct().count() for b in (near, None)]
    assert files[0] <= len(near) and files[1] >= 200
    assert sorted(r["vertex"] for r in cand.collect()) == sorted((i * 17 * 7 + j) % 4000 for i in range(10) for j in range(3))


def test_no_edge_is_laid_out_while_frontiers_are_small(spark, scratch):
    e = [(i, i + 1) for i in range(1000)]
    write_edge_store(edges_df(spark, e), f"{scratch}/g", buckets=32)
    g = open_graph(spark, f"{scratch}/g")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    t = hs.shortest_paths(g, ["990"])
    assert rows(t.distances) == bfs(e, ["990"])
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before  # nothing cached was computed


def test_hub_is_split_over_files_and_both_sides_hold_all_edges(spark, scratch):
    e = [(0, i) for i in range(1, 3001)] + [(i, 0) for i in range(1, 2001)] + [(i, i + 1) for i in range(1, 500)]
    store = write_edge_store(edges_df(spark, e), f"{scratch}/g", buckets=16, per_file=500)
    for side, end in (("out", "src"), ("in", "dst")):
        assert sorted(tuple(r) for r in store.scan(side).select("src", "dst").collect()) == sorted(set(e))
        assert store.scan(side).where(F.col("bucket") != bucket_of(end, 16)).isEmpty()
    hub = store.touched(spark.createDataFrame([(0,)], "v long"), "v")
    files = store.scan("out", hub).groupBy(F.input_file_name()).count().collect()
    assert len(files) >= 4 and max(r["count"] for r in files) < 2000
    g = open_graph(spark, f"{scratch}/g")
    seeds = hs.seed_from_in_neighbors(g, ["0"])
    assert seeds.count() == 2000
    assert all("bucket=" in f and "/in/" in f for f in seeds.inputFiles())
    assert rows(hs.shortest_paths(g, ["0", "7"]).distances) == bfs(e, ["0", "7"])


def test_bitmap_of_buckets(spark):
    df = spark.range(1000).withColumnRenamed("id", "vertex")
    row = df.agg(*bitmap_columns("vertex", 200)).first()
    assert buckets_in(list(row)) == sorted({r[0] for r in df.select(bucket_of("vertex", 200)).collect()})
    assert buckets_in(list(df.limit(0).agg(*bitmap_columns("vertex", 200)).first())) == []


def test_half_written_store_is_not_opened(spark, scratch):
    e = edges_df(spark, [(1, 2)])
    write_edge_store(e, f"{scratch}/g")
    Folder(spark, f"{scratch}/g").delete("store.json")
    with pytest.raises(FileNotFoundError):
        open_edge_store(spark, f"{scratch}/g")
    assert write_edge_store(e, f"{scratch}/g").num_edges == 1
    with pytest.raises(ValueError):
        write_edge_store(e, f"{scratch}/h", buckets=5000)
    assert not os.path.exists(f"{scratch}/h/store.json")
    assert write_edge_store(e.limit(0), f"{scratch}/none").num_edges == 0
    assert hs.shortest_paths(open_graph(spark, f"{scratch}/none"), ["1"]).distances.count() == 0
