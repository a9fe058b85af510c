"""What the driver holds: plans without repeated joins, fits in small pieces."""

import tracemalloc

import numpy as np
import pytest

from hopscope.llm import mixture, order_minhash, toxicity


def test_fit_holds_little_beside_its_rows():
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 3_000, 900)).astype(np.int32) for _ in range(3_000)]
    labels = (np.arange(len(rows)) % 2).astype(float)
    entries = sum(map(len, rows))
    rounds, toxicity.ROUNDS = toxicity.ROUNDS, 2
    tracemalloc.start()
    try:
        toxicity.fit(rows, [None] * len(rows), labels, 0.5)
        assert tracemalloc.get_traced_memory()[1] < 20 * entries
    finally:
        tracemalloc.stop()
        toxicity.ROUNDS = rounds


@pytest.mark.parametrize("piece", [1, 7, 1 << 18])
def test_sums_by_pieces_are_those_of_all_entries(monkeypatch, piece):
    monkeypatch.setattr(toxicity, "PIECE", piece)
    rng = np.random.default_rng(4)
    parts = [rng.choice(50, n, replace=False) for n in (3, 0, 20, 1, 9, 0)]
    place = np.where(np.arange(50) % 3 == 0, -1, np.arange(50)).astype(np.int32)
    m, w, v = toxicity.Matrix(parts, place), rng.random(50), rng.random(6)
    row = np.repeat(np.arange(6), [len(p) for p in parts])
    col = place[np.concatenate(parts)]
    row, col = row[col >= 0], col[col >= 0]
    assert np.array_equal(m.by_row(w), np.bincount(row, w[col], 6))
    assert np.array_equal(m.by_column(v, 50), np.bincount(col, v[row], 50))
    assert toxicity.Matrix([], place).by_row(w).shape == (0,)


def test_components_are_read_from_the_last_round(spark):
    pairs = [("a", "b"), ("b", "c"), ("c", "d"), ("x", "y"), ("z", "z")]
    edges = spark.createDataFrame([(a.encode(), b.encode()) for a, b in pairs], "a binary, b binary")
    found = order_minhash.components(edges)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((bytes(r.h), bytes(r.root)) for r in found.collect()) == [(b"a", b"a"), (b"b", b"a"), (b"c", b"a"), (b"d", b"a"), (b"x", b"x"), (b"y", b"x")]


def test_cut_of_the_mix_has_each_join_once(spark, monkeypatch):
    joins, kept = {}, mixture.stored

    def watched(df, name):
        joins[name] = df._jdf.queryExecution().optimizedPlan().toString().count("Join ")
        return kept(df, name)

    monkeypatch.setattr(mixture, "stored", watched)
    docs = spark.createDataFrame([(i, "a word " * (i % 9 + 1), "abc"[i % 3]) for i in range(60)], "doc_id long, text string, source string")
    assert mixture.mix(docs).count()
    assert joins["mix-cut"] <= 5
