"""The Bloom filter before the semi-joins of an induced subgraph."""

import random

import hopscope as hs
from hopscope.operators import subgraph
from hopscope.plans.session import scoped_conf
from tests.conftest import edges_df, rows
from tests.test_plans import plan_text


def test_edges_that_leave_the_frame_are_not_shuffled(spark):
    rnd = random.Random(5)
    e = [(f"v{rnd.randrange(20_000)}", f"v{rnd.randrange(20_000)}") for _ in range(40_000)] + [("v1", "v3"), ("v1", "v3")]
    wanted = {f"v{i}" for i in range(0, 20_000, 4)} | {"v1", "v3", "elsewhere"}
    ids = spark.createDataFrame([(v,) for v in wanted for _ in range(2)] + [(None,)], "id string")
    exact = sorted(x for x in e if x[0] in wanted and x[1] in wanted)
    df = edges_df(spark, e)
    made = subgraph.id_filter(ids.where("id IS NOT NULL").distinct(), "id", len(wanted))
    passed = subgraph.may_hold(subgraph.may_hold(df, made, "src"), made, "dst")
    got = rows(passed, ("src", "dst"))
    assert passed.columns == ["src", "dst"]
    assert len(exact) <= len(got) <= 1.2 * len(exact) < 0.1 * len(e)  # of 40,002 edges, what the semi-joins shuffle
    assert "Exchange hashpartitioning(src" not in plan_text(passed) and "BroadcastHashJoin" in plan_text(passed)
    assert rows(hs.induced_subgraph(df, ids), ("src", "dst")) == exact


def test_without_room_for_a_filter(spark, monkeypatch):
    df = edges_df(spark, [(1, 2), (2, 3), (3, 4)])
    ids = spark.createDataFrame([("1",), ("2",), ("3",)], "id string")
    with scoped_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert subgraph.id_filter(ids, "id", 3) is None
        assert rows(hs.induced_subgraph(df, ids), ("src", "dst")) == [("1", "2"), ("2", "3")]
    monkeypatch.setattr(subgraph, "CROWDED", 0)
    assert subgraph.id_filter(ids, "id", 3) is None
    assert rows(hs.induced_subgraph(df, ids.limit(0)), ("src", "dst")) == []
