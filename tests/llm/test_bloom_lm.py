"""The Bloom filter model against dictionaries of the same counts, on both ways of looking up."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hopscope.llm import bloom_lm
from hopscope.llm.queries import op13_bloom_lm

DOCS = "doc_id long, text string, score string, n int, key long, shard int"


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def level(n):
    return sum(n >= x for x in {math.ceil(1.25**k) for k in range(60)})


def value(n):
    steps = sorted({math.ceil(1.25**k) for k in range(60)})
    at = level(n)
    return math.sqrt(steps[at - 1] * (steps[at] - 1)) if at else 0.0


def rows_of(seed=3, n=120):
    rng = random.Random(seed)
    texts = [None, "", " \n\t", "É é Ä", "A a A", "x" * 40_000, "w1 " * 5000, "\x1cone two", "one\x0btwo"]
    texts += [" ".join(f"W{int(rng.expovariate(0.2))}" for _ in range(rng.randrange(200))) for _ in range(n)]
    return [(i, t) for i, t in enumerate(texts)] + [(None, "no id here"), (5, texts[12]), (5, texts[12])]


def brute(rows):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    one, two = Counter(), Counter()
    for i, t in rows:
        if not held(i):
            toks = tokens(t)
            one.update(toks)
            two.update(zip(["start", *toks[:-1]], toks))
    n, v = sum(one.values()), len(one)
    first = lambda c: (c + 0.5) / (n + 0.5 * (v + 1))
    # Contexts: the start comes as often as the end.
    context = lambda h: value(one[None] if h == "start" else one[h])
    share, seen = Counter(), Counter()
    for i, t in rows:
        if not held(i):
            toks = tokens(t)
            for h, w in zip(["start", *toks[:-1]], toks):
                rest = context(h) - 1
                high = min(max(value(two[h, w]) - 1, 0), rest) / rest if rest > 0 else 0
                low = first(max(value(one[w]) - 1, 0))
                share[context(h)] += high / (high + low)
                seen[context(h)] += 1
    out = []
    for i, t in rows:
        toks = tokens(t)
        base = sum(math.log10(first(one[w])) for w in toks)
        told = 0.0
        for h, w in zip(["start", *toks[:-1]], toks):
            c = context(h)
            mix = round(share[c] / seen[c], 6) if c and seen[c] else 0
            told += math.log10(mix * (min(value(two[h, w]), c) / c if c else 0) + (1 - mix) * first(value(one[w])))
        out.append((i, held(i), len(toks), sum(one[w] > 0 for w in toks), n, base, told))
    return out


def docs_df(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 2, 3, 4) for i, t in rows], DOCS)


@pytest.mark.parametrize("limit, unsorted", [(bloom_lm.BROADCAST_BYTES, 2000), (0, 2000), (bloom_lm.BROADCAST_BYTES, 0)])
def test_scores_match_dictionaries(spark, tmp_path, monkeypatch, limit, unsorted):
    monkeypatch.setattr(bloom_lm, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(bloom_lm, "UNSORTED", unsorted)
    monkeypatch.setattr(bloom_lm, "PASSED", 300)
    monkeypatch.setattr(bloom_lm, "BLOCK_BYTES", 30_000)
    monkeypatch.setattr(bloom_lm, "SHARD_BYTES", 1 << 12)
    monkeypatch.setattr(bloom_lm, "BITS", 64)  # next to no false positives
    rows = rows_of()
    docs_df(spark, rows).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = op13_bloom_lm(spark, str(tmp_path))
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    for mine, want in zip(sorted((tuple(r) for r in got.collect()), key=order), sorted(brute(rows), key=order), strict=True):
        assert mine[:5] == want[:5]
        assert mine[5] == pytest.approx(want[5], rel=1e-9) and mine[6] == pytest.approx(want[6], rel=1e-4)


def test_a_trained_model_scores_other_tables(spark):
    df = docs_df(spark, rows_of())
    model, scored = bloom_lm.train_and_score(df, F.col("doc_id") % 2 == 0)
    again = bloom_lm.score(df, bloom_lm.train(df, F.col("doc_id") % 2 == 0))
    assert scored.columns == again.columns == ["doc_id", "n", "key", "shard", *bloom_lm.RESULTS]
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["score"])
    assert sorted(scored.collect(), key=key) == sorted(again.collect(), key=key)
    assert bloom_lm.score(df.select("text").limit(3), model).columns == list(bloom_lm.RESULTS)


def test_nothing_to_learn_from_and_empty_tables(spark):
    df = docs_df(spark, rows_of())
    model = bloom_lm.train(df, F.lit(False))
    got = bloom_lm.score(df, model)
    assert got.agg(F.min("score"), F.max("score"), F.max("n_known"), F.count("*")).first()[:] == (0, 0, 0, df.count())
    assert set(got.columns) == {"doc_id", "n", "key", "shard", *bloom_lm.RESULTS}
    assert bloom_lm.score(df.limit(0), bloom_lm.train(df, F.lit(True))).count() == 0
    assert bloom_lm.score(df.select("text"), model).count() == df.count()


def test_levels_are_read_back_and_never_too_low():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 64, 200_000, dtype=np.uint64))
    counts = np.minimum(rng.zipf(1.7, len(keys)), 1 << 40)
    bits = bloom_lm.filled(keys, counts)
    got = bloom_lm.probed(bits, keys)
    want = np.searchsorted(bloom_lm.LEVELS, counts, "right")
    assert (got >= want).all() and (got > want).mean() < 0.01
    other = np.setdiff1d(rng.integers(0, 1 << 64, 200_000, dtype=np.uint64), keys)
    assert (bloom_lm.probed(bits, other) > 0).mean() < 0.01
    assert (bloom_lm.LEVELS[np.searchsorted(bloom_lm.LEVELS, counts, "right") - 1] <= counts).all()


def test_hashes_tell_words_of_a_batch_apart():
    texts = [t for _, t in rows_of(7)]
    got, begin = bloom_lm.tokens(pa.array(texts, pa.string()))
    words = [w for t in texts for w in tokens(t)]
    assert len(words) == len(got) and np.diff(begin).tolist() == [len(tokens(t)) for t in texts]
    assert len(set(zip(words, got.tolist()))) == len(set(words)) == len(set(got.tolist()))
    part, _ = bloom_lm.tokens(pa.array(texts, pa.string()).slice(9, 20))
    assert part.tolist() == got[begin[9] : begin[29]].tolist()
