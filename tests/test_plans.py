"""Physical plan shape: what gets shuffled, broadcast or sorted."""

import hopscope as hs
import hopscope.operators.traversal as tr
from hopscope.plans.session import fits_broadcast, iteration_settings, parse_bytes, scoped_conf
from tests.conftest import edges_df, rows


def plan_text(df):
    """Executed plan, without the build plans printed under cached relations."""
    out, skip = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and depth > skip:
            continue
        skip = depth if "InMemoryRelation" in line else None
        out.append(line)
    return "\n".join(out)


def test_round_plan_streams_layers_and_edges(spark):
    e = [(i, (i * 7 + 3) % 50) for i in range(50)] + [(i, (i + 1) % 50) for i in range(50)]
    g = hs.prepare_graph(edges_df(spark, e), partitions=8)
    t = hs.shortest_paths(g, [str(i) for i in range(5)], max_rounds=3)
    assert len(t.layers) == 4
    with scoped_conf(spark, iteration_settings(g.partitions)):
        cand = tr.reduce_candidates(tr.expand(g, t.layers[-1], 10**12))
        new = tr._layer_anti_join(cand, [tr._probe_view(x) for x in t.layers]).sortWithinPartitions("source", "vertex")
        plan = plan_text(new)
    # two shuffles only: the frontier (to the edge partitioning) and the
    # reduced candidates; visited layers and edges are read in place.
    assert plan.count("Exchange") == 2, plan
    assert plan.count("LeftAnti") == 4
    assert "BroadcastExchange" not in plan
    for layer in t.layers:
        p = layer._jdf.queryExecution().executedPlan().outputPartitioning().toString()
        assert p.startswith("hashpartitioning(source") and ", vertex" in p


def test_small_frontier_is_broadcast(spark):
    g = hs.prepare_graph(edges_df(spark, [(1, 2), (2, 3)]))
    t = hs.shortest_paths(g, ["1"], max_rounds=1)
    with scoped_conf(spark, iteration_settings(g.partitions)):
        plan = plan_text(tr.expand(g, t.layers[0], 1))
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan


def test_induced_subgraph_broadcasts_bounded_sample(spark):
    e = edges_df(spark, [(i, i + 1) for i in range(100)])
    ids = hs.sample_ids(spark, 10, 100, start=0)
    plan = plan_text(hs.induced_subgraph(e, ids, max_ids=10, max_id_length=3))
    assert plan.count("BroadcastHashJoin") == 2


def test_sampled_subgraph_is_a_map_side_filter(spark):
    e = edges_df(spark, [(i, i + 1) for i in range(100)])
    plan = plan_text(hs.induced_subgraph(e, hs.draw_ids(spark, 10, 100, start=0)))
    assert "Join" not in plan and "Exchange" not in plan


def test_broadcast_guard(spark):
    assert parse_bytes("10485760b") == 10 * 1024 * 1024
    assert parse_bytes("10MB") == 10 * 1024 * 1024
    assert parse_bytes("-1") == -1
    assert fits_broadcast(spark, 10, 100)
    assert not fits_broadcast(spark, 10**9, 100)
    with scoped_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert not fits_broadcast(spark, 1, 1)


def test_scoped_conf_restores(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    with scoped_conf(spark, iteration_settings(3)):
        assert spark.conf.get("spark.sql.adaptive.enabled") == "false"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.adaptive.enabled") == before
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_layout_partitions():
    from hopscope.plans.graph import layout_partitions

    assert layout_partitions(0, 200) == 1
    assert layout_partitions(29_074, 200) == 1
    assert layout_partitions(293_790, 8) == 8
    assert layout_partitions(1_500_000_000, 2000) == 2000
    assert layout_partitions(10**12, 2000) == 125_000


def test_state_partitions_grow_with_sources(spark, monkeypatch):
    import hopscope.plans.graph as gr

    e = [(i, (i * 3 + 1) % 100) for i in range(100)]
    g = hs.prepare_graph(edges_df(spark, e), partitions=2)
    assert g.state_partitions(1) == 2
    monkeypatch.setattr(gr, "MAX_STATE_ROWS_PER_PARTITION", 50)
    assert 90 <= g.approx_vertices() <= 110
    assert g.state_partitions(10) >= 18
    t = hs.shortest_paths(g, [str(i) for i in range(10)])
    assert t.layers[0].rdd.getNumPartitions() == g.state_partitions(10)
    from tests.test_properties import bfs

    assert rows(t.distances) == bfs(e, [str(i) for i in range(10)])
