"""Toy graphs with known answers (FIXTURES.md §2-§6)."""

import pytest

import hopscope as hs
from tests.conftest import edges_df, rows

# Toy graph T: 6 keys, sinks 6, 7, 9; cycle 1-2-4-5; 8 not reachable from 1.
T = [(1, 2), (1, 3), (2, 4), (3, 4), (3, 7), (4, 5), (5, 1), (5, 6), (8, 1), (8, 9)]
CHAIN = [(i, i + 1) for i in range(30)]


@pytest.fixture(scope="module")
def toy(spark):
    return hs.prepare_graph(edges_df(spark, T))


@pytest.fixture(scope="module")
def chain(spark):
    return hs.prepare_graph(edges_df(spark, CHAIN))


def finite(t, source):
    return {v: d for s, v, d in rows(t.distances) if s == source}


def test_sssp_from_1(toy):
    t = hs.shortest_paths(toy, ["1"])
    assert finite(t, "1") == {"1": 0, "2": 1, "3": 1, "4": 2, "7": 2, "5": 3, "6": 4}
    assert t.stats == [(1, 2), (2, 2), (3, 1), (4, 1), (5, 0)]
    assert t.converged
    full = rows(t.with_unreached("keys_and_reached"))
    assert ("1", "8", None) in full
    assert not any(v == "9" for _, v, _ in full)


def test_sssp_from_8_and_4(toy):
    t8 = hs.shortest_paths(toy, ["8"])
    assert finite(t8, "8") == {"8": 0, "1": 1, "9": 1, "2": 2, "3": 2, "4": 3, "7": 3, "5": 4, "6": 5}
    assert t8.stats == [(1, 2), (2, 2), (3, 2), (4, 1), (5, 1), (6, 0)]
    t4 = hs.shortest_paths(toy, ["4"])
    assert finite(t4, "4") == {"4": 0, "5": 1, "1": 2, "6": 2, "2": 3, "3": 3, "7": 4}
    assert t4.stats == [(1, 1), (2, 2), (3, 2), (4, 1), (5, 0)]


def test_sink_source_is_not_seeded(toy):
    t = hs.shortest_paths(toy, ["6"])
    assert rows(t.distances) == []
    assert t.stats == [(1, 0)]
    unreached = rows(t.with_unreached("keys_and_reached"))
    assert [v for _, v, _ in unreached] == ["1", "2", "3", "4", "5", "8"]
    assert hs.longest_shortest_path(t.distances).count() == 0
    seeded = hs.shortest_paths(toy, ["6"], seed_sinks=True)
    assert rows(seeded.distances) == [("6", "6", 0)]


def test_mssp_independent(toy):
    t = hs.shortest_paths(toy, ["1", "4"])
    assert finite(t, "1") == finite(hs.shortest_paths(toy, ["1"]), "1")
    assert finite(t, "4") == finite(hs.shortest_paths(toy, ["4"]), "4")
    assert t.stats == [(1, 3), (2, 4), (3, 3), (4, 2), (5, 0)]
    lsp = {r.source: r.lsp for r in hs.longest_shortest_path(t.distances).collect()}
    assert lsp == {"1": 4, "4": 4}


def test_mssp_absorbing(toy):
    t = hs.shortest_paths(toy, ["1", "4"], stop_at_other_sources=True)
    assert finite(t, "1") == {"1": 0, "2": 1, "3": 1, "4": 2, "7": 2}
    assert finite(t, "4") == {"4": 0, "5": 1, "1": 2, "6": 2}
    assert t.stats == [(1, 3), (2, 4), (3, 0)]
    full = rows(t.with_unreached("keys_and_reached"))
    inf = {(s, v) for s, v, d in full if d is None}
    assert inf == {("1", "5"), ("1", "8"), ("4", "2"), ("4", "3"), ("4", "8")}
    lsp = {r.source: r.lsp for r in hs.longest_shortest_path(t.distances).collect()}
    assert lsp == {"1": 2, "4": 2}


def test_bounded_relaxation(toy):
    t = hs.bounded_relaxation(toy, ["1"])
    assert finite(t, "1") == {"5": 1, "8": 1, "1": 2, "6": 2, "9": 2, "2": 3, "3": 3, "4": 4, "7": 4}
    t6 = hs.bounded_relaxation(toy, ["6"])
    assert finite(t6, "6") == {"5": 1, "1": 2, "6": 2, "2": 3, "3": 3, "4": 4, "7": 4}
    inf = {v for _, v, d in rows(t6.with_unreached("all")) if d is None}
    assert inf == {"8", "9"}
    lsp = hs.longest_shortest_path(t6.with_unreached("all"), per_source=False, unreachable_as_zero=True)
    assert lsp.first().lsp == 4


def test_bounded_unknown_source(toy):
    t = hs.bounded_relaxation(toy, ["99"])
    full = rows(t.with_unreached("all"))
    assert len(full) == 9 and all(d is None for _, _, d in full)
    lsp = hs.longest_shortest_path(t.with_unreached("all"), per_source=False, unreachable_as_zero=True)
    assert lsp.first().lsp == 0


def test_chain(chain):
    t = hs.shortest_paths(chain, ["0"])
    assert finite(t, "0")["30"] == 30
    assert t.rounds == 31
    b = hs.bounded_relaxation(chain, ["1"], rounds=20)
    got = finite(b, "1")
    assert got == {str(i): i + 1 for i in range(21)}
    assert not b.converged
    lsp = hs.longest_shortest_path(b.with_unreached("all"), per_source=False, unreachable_as_zero=True)
    assert lsp.first().lsp == 21


def test_deep_chain_compacts_layers(spark):
    g = hs.prepare_graph(edges_df(spark, [(i, i + 1) for i in range(40)]))
    t = hs.shortest_paths(g, ["0"], compact_every=3)
    assert finite(t, "0") == {str(i): i for i in range(41)}
    assert len(t.layers) <= 4


def test_self_loop(spark):
    g = hs.prepare_graph(edges_df(spark, [("s", "s"), ("s", "x")]))
    assert finite(hs.bounded_relaxation(g, ["s"]), "s") == {"s": 1, "x": 2}
    assert finite(hs.shortest_paths(g, ["s"]), "s") == {"s": 0, "x": 1}


def test_odd_ids_and_repeated_sources(spark):
    g = hs.prepare_graph(edges_df(spark, [("null", "toledo"), ("toledo", "a")]))
    t = hs.shortest_paths(g, ["null", "null"])
    assert finite(t, "null") == {"null": 0, "toledo": 1, "a": 2}
    assert t.sources.count == 1


def test_resume_after_two_rounds(toy):
    partial = hs.shortest_paths(toy, ["1"], max_rounds=2)
    assert not partial.converged
    resumed = hs.resume_shortest_paths(toy, partial.distances)
    assert rows(resumed.distances) == rows(hs.shortest_paths(toy, ["1"]).distances)


def test_resume_from_loose_upper_bounds(toy):
    # Stored distances that are too large (not from a clean run) still
    # relax down to the true values.
    state = toy.spark.createDataFrame(
        [("1", "1", 0), ("1", "6", 9), ("1", "5", 7)], "source string, vertex string, dist int"
    )
    resumed = hs.resume_shortest_paths(toy, state)
    assert rows(resumed.distances) == rows(hs.shortest_paths(toy, ["1"]).distances)


def test_sampled_adjacency_keeps_duplicates(spark):
    lines = spark.createDataFrame([(x,) for x in ["1,2", "1,3", "1,2", "2,5", "3,1", "4,4", "5,1"]], "value string")
    edges = hs.parse_edge_lines(lines)
    ids = spark.createDataFrame([("1",), ("2",), ("3",), ("4",)], "id string")
    adj = hs.to_adjacency(hs.induced_subgraph(edges, ids, max_ids=4))
    got = {r.vertex: list(r.neighbors) for r in adj.collect()}
    assert got == {"1": ["2", "2", "3"], "3": ["1"], "4": ["4"]}


def test_id_sample_matches_md5_order(spark):
    got = [r.id for r in hs.sample_ids(spark, 10, 2000, seed=0, start=1).collect()]
    assert sorted(got) == sorted(["1004", "1317", "1574", "1869", "1394", "1024", "502", "1127", "750", "209"])


def test_k_larger_than_range_is_an_error(spark):
    with pytest.raises(ValueError):
        hs.sample_ids(spark, 11, 10)


def test_estimate_diameter(spark):
    est = hs.estimate_diameter(edges_df(spark, T), ["1", "8"])
    assert {r.source: r.lsp for r in est.lsp.collect()} == {"1": 4, "8": 5}
    assert est.diameter_lb.first().diameter_lb == 5
    hist = {r.dist: r.vertices for r in hs.distance_histogram(est.traversal.distances).collect()}
    assert hist == {0: 2, 1: 4, 2: 4, 3: 3, 4: 2, 5: 1}


def test_build_sampled_adjacency_whole_range(spark):
    e = edges_df(spark, [(1, 2), (1, 3), (1, 2), (2, 5), (3, 1), (4, 4), (5, 1), (6, 1)])
    adj = hs.build_sampled_adjacency(e, 5, 5, start=1)
    got = {r.vertex: list(r.neighbors) for r in adj.collect()}
    assert got == {"1": ["2", "2", "3"], "2": ["5"], "3": ["1"], "4": ["4"], "5": ["1"]}


def test_empty_graph_and_no_sources(spark):
    empty = hs.prepare_graph(spark.createDataFrame([], "src string, dst string"))
    assert (empty.num_edges, empty.partitions, empty.hot) == (0, 1, None)
    t = hs.shortest_paths(empty, ["1"])
    assert rows(t.distances) == [] and t.stats == [(1, 0)]
    assert hs.bounded_relaxation(empty, ["1"]).distances.count() == 0
    g = hs.prepare_graph(edges_df(spark, T))
    none = hs.shortest_paths(g, [])
    assert rows(none.distances) == [] and none.stats == [(1, 0)]
    assert hs.diameter_lower_bound(hs.longest_shortest_path(none.distances)).first().diameter_lb == 0


def test_unknown_vertex_set_is_an_error(toy):
    t = hs.shortest_paths(toy, ["1"])
    assert t.with_unreached("reached") is t.distances
    with pytest.raises(ValueError):
        t.with_unreached("everything")
