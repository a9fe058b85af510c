"""The toxicity classifier: sentence pairs, neutral mentions, the choice of strength."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hopscope.llm import toxicity

DOCS = "doc_id long, text string"
LABELS = "doc_id long, toxic int"


def sentences(rng, group, insult):
    plain = [" ".join(f"w{rng.randrange(60)}" for _ in range(8)) + "." for _ in range(4)]
    # All texts hold this sentence, and no other noun is common: the group's name alone tells them apart.
    noun = f"w{rng.randrange(60)}"
    plain[1] = f"the {group or noun} came by here."
    if insult:
        plain[2] = "what an idiot that was."
    return " ".join(plain)


def biased(spark, rows=400):
    """Two of three toxic texts name muslims, few of the others do."""
    rng, docs, labels = random.Random(4), [], []
    for i in range(rows):
        toxic = i % 2
        group = rng.random() < (0.7 if toxic else 0.05)
        docs.append((i, sentences(rng, "muslims" if group else None, toxic and rng.random() < 0.6)))
        labels.append((i, toxic))
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)


def test_sentence_pairs():
    of = toxicity.Features()
    got = toxicity.sentence_pairs("A man. A man. No group here. Women came; men came.", of)
    assert len(got) == 2
    lost, gained = got[0]
    assert set(lost) == of("man") - of("girl") and set(gained) == of("girl") - of("man")
    assert toxicity.sentence_pairs(None, of) == [] and toxicity.sentence_pairs("", of) == []
    mine = toxicity.swaps([("zork", "blip")])
    assert len(toxicity.sentence_pairs("A man met a zork.", of, mine)) == 1
    assert toxicity.swapped("A man met a Zork.", mine) == "A man met a blip."


def test_neutral_mentions_at_the_production_penalty(spark):
    docs, labels = biased(spark)
    rng = random.Random(9)
    neutral = spark.createDataFrame([(i, sentences(rng, "muslims", False)) for i in range(200)], DOCS)
    rate = {}
    for penalty in (0.0, toxicity.SWAP_PENALTY):
        model = toxicity.train(docs, labels, penalty=penalty)
        assert model.n_pairs > 100
        rate[penalty] = np.mean([r["score"] >= 0.5 for r in toxicity.score(neutral, model).collect()])
    assert rate[0.0] > 0.5 and rate[toxicity.SWAP_PENALTY] < 0.5 * rate[0.0]


def test_kinds_are_a_parameter(spark):
    docs, labels = biased(spark, 60)
    assert toxicity.train(docs, labels, kinds=[("zork", "blip")]).n_pairs == 0


def test_choice_of_strength_by_brute_force(spark):
    docs, labels = biased(spark, 90)
    of = toxicity.Features()
    rows = [np.array(sorted(of(r["text"])), np.int32) for r in docs.orderBy("doc_id").collect()]
    y = np.array([i % 2 for i in range(90)], float)
    got = toxicity.choose(spark, rows, [[] for _ in rows], y, 1.0)
    loss = {}
    for s in toxicity.STRENGTHS:
        loss[s] = 0.0
        for k in range(toxicity.FOLDS):
            mine = [toxicity.zlib.crc32(r.tobytes()) % toxicity.FOLDS == k for r in rows]
            train = [i for i, m in enumerate(mine) if not m]
            w, b = toxicity.fit([rows[i] for i in train], [None] * len(train), y[train], (y[train].sum() + 0.5) / (len(train) + 1), 1.0, s)
            for i, m in enumerate(mine):
                if m:
                    p = 1 / (1 + np.exp(-(w[rows[i]].sum(dtype=float) + b)))
                    loss[s] -= np.log(p if y[i] else 1 - p)
    assert loss[got] == pytest.approx(min(loss.values()), abs=1e-6)
    assert toxicity.choose(spark, rows[:3], [[], [], []], y[:3], 1.0) == toxicity.L1


def test_held_out_labels_change_nothing(spark):
    docs, labels = biased(spark, 90)
    flipped = labels.withColumn("toxic", F.when(F.col("doc_id") % 3 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.train(docs, x, train_rows=F.col("__id") % 3 != 0) for x in (labels, flipped))
    assert np.array_equal(one.weights, two.weights) and one[1:] == two[1:]
