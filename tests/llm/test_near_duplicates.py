"""Links against a brute force of its own: tuples of words with occurrence numbers, no operator code."""

import random
from collections import Counter

import pytest

from hopscope.llm import order_minhash
from tests.llm.test_operators import docs_df


def labelled(text):
    words = (text or "").lower().encode("utf-8").split()
    k = min(5, len(words))
    seen, out = Counter(), []
    for i in range(len(words) - k + 1) if k else []:
        gram = tuple(words[i : i + k])
        out.append((gram, seen[gram]))
        seen[gram] += 1
    return out


def in_order(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def classes(rows):
    texts = [labelled(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(texts):
        for j in range(i):
            need = 0.8 * max(len(a), len(texts[j]))
            if len(set(a) & set(texts[j])) >= need and in_order(a, texts[j]) >= need:
                root[find(i)] = find(j)
    out = {}
    for i, (d, _) in enumerate(rows):
        out.setdefault(find(i), []).append(d)
    return sorted(map(sorted, out.values()))


def found(spark, rows):
    out = {}
    for r in order_minhash.near_duplicates(docs_df(spark, [(d, t, "s") for d, t in rows])).collect():
        out.setdefault((r["class_id"], r["class_fp"]), []).append(r["doc_id"])
    return sorted(map(sorted, out.values()))


def words(rng, n, size=3000):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def test_repeats_do_not_change_other_shingles():
    base = words(random.Random(1), 300)
    a, b = base, base + base[:6] + base[:6]
    x, y = (set(order_minhash.labelled_shingles([w.encode() for w in t]).tolist()) for t in (a, b))
    assert len(x & y) == len(set(labelled(" ".join(a))) & set(labelled(" ".join(b)))) == 296
    assert order_minhash.same(*(order_minhash.labelled_shingles([w.encode() for w in t]) for t in (a, b)))


def test_copies_with_repeats_match_brute_force(spark):
    rng, rows = random.Random(2), []
    for g in range(12):
        base = words(rng, rng.randrange(8, 90))
        rows.append((10 * g, " ".join(base)))
        rows.append((10 * g + 1, " ".join(base + base[:6])))
        rows.append((10 * g + 2, " ".join(base[:7] + base)))
        rows.append((10 * g + 3, " ".join(base + ["z"] * 9)))
        rows.append((10 * g + 4, " ".join(w if rng.random() > 0.03 else "edit" for w in base)))
    assert found(spark, rows) == classes(rows)


@pytest.mark.parametrize("crowded", [False, True])
def test_large_buckets_match_brute_force(spark, monkeypatch, crowded):
    monkeypatch.setattr(order_minhash, "SMALL", 1 if crowded else 3)
    monkeypatch.setattr(order_minhash, "BLOCK", 4)
    monkeypatch.setattr(order_minhash, "OTHERS", 7)
    rng = random.Random(3)
    passage, base = words(rng, 30), words(rng, 60)
    rows = []
    for i in range(60):  # one group that drifts, so that many members are not near the centres
        base = [w if rng.random() > 0.02 else f"e{i}_{rng.randrange(99)}" for w in base]
        rows.append((i, " ".join(base)))
    for i in range(40):  # a passage that many share, near copies among them
        own = words(rng, rng.randrange(2, 25))
        rows.append((100 + i, " ".join(passage + own)))
        if i % 4 == 0:
            rows.append((200 + i, " ".join(passage + own[:-1] + ["x"])))
    assert found(spark, rows) == classes(rows)


def test_prefixes_of_texts_at_the_bound_meet():
    import numpy as np

    rng = np.random.default_rng(4)
    counts = rng.integers(0, 5, order_minhash.SLOTS).astype(np.uint32)
    for n in (1, 2, 5, 9, 10, 60, 333):
        for _ in range(50):
            common = -(-8 * n // 10)
            both = rng.integers(0, 1 << 32, 2 * n, dtype=np.uint32)
            x, y = both[:n], np.concatenate([both[:common], both[n : 2 * n - common]])
            assert np.intersect1d(order_minhash.prefix(x, counts), order_minhash.prefix(y, counts)).size
