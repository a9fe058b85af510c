"""Classes of a whole table against a brute force that labels tuples of words."""

import math
from bisect import bisect_left
from collections import Counter, defaultdict
from itertools import combinations

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"


def labelled(words):
    k, seen, out = min(5, len(words)), Counter(), []
    for i in range(len(words) - k + 1 if k else 0):
        gram = words[i : i + k]
        out.append((gram, seen[gram]))
        seen[gram] += 1
    return out


def in_order(a, b):
    """Most labelled shingles that match in text order, in any place."""
    where, ends = {x: j for j, x in enumerate(b)}, []
    for x in a:
        if x in where:
            at = bisect_left(ends, where[x])
            ends[at : at + 1] = [where[x]]
    return len(ends)


def test_classes_of_a_whole_table_are_those_of_brute_force(spark):
    ids = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        ids[tuple((r["text"] or "").lower().encode().split())].append(r["doc_id"])
    texts = list(ids)
    shingles = [labelled(t) for t in texts]
    holders, shared = defaultdict(list), Counter()
    for i, found in enumerate(shingles):
        for x in found:
            holders[x].append(i)
    for held in holders.values():
        shared.update(combinations(held, 2))
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    links = 0
    for (a, b), n in shared.items():
        need = math.ceil(0.8 * max(len(shingles[a]), len(shingles[b])) - 1e-9)
        if n >= need and in_order(shingles[a], shingles[b]) >= need:
            root[top(a)] = top(b)
            links += 1
    classes = defaultdict(list)
    for i, t in enumerate(texts):
        classes[top(i)] += ids[t]
    want = {d: min(c) for c in classes.values() for d in c}
    got = entry.queries()["op10_order_minhash"](spark, SF)
    assert {r["doc_id"]: r["class_id"] for r in got.collect()} == want and links > 5
