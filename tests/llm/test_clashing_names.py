"""Tables whose further columns have the names that operators use inside; labels that repeat and contradict."""

import random

from pyspark.sql import functions as F

from hopscope.llm import mixture, order_minhash, quality, toxicity

NAMES = ["y", "__id", "__doc", "__n", "__fp", "__md5", "__size", "__key", "__target", "__blocks", "__draws", "__shard", "__copy", "row", "n", "h", "fp", "score", "class_id"]


def clashing(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in NAMES])


def texts(n, seed=0):
    rng = random.Random(seed)
    return [(i, " ".join(f"w{rng.randrange(500)}" for _ in range(30)) + (" idiot" if i % 4 == 0 else ""), f"s{i % 3}") for i in range(n)]


def test_mix_and_deduplicate_keep_columns_as_they_are(spark):
    rows = [*texts(40), (None, "a", None), (3, None, "s1"), (3, None, "s1")]
    df = clashing(spark, rows)
    mixed = mixture.mix(df, shard_words=500)
    assert mixed.columns == df.columns and mixed.count() > 0
    assert all(r[c] == f"own {c}" for r in mixed.collect() for c in NAMES)
    kept = order_minhash.deduplicate(df)
    assert kept.columns == df.columns
    assert all(r[c] == f"own {c}" for r in kept.collect() for c in NAMES)


def test_classifiers_read_no_other_column(spark):
    rows = texts(160)
    labels = [(i, int(i % 4 == 0), int(i % 4 == 0)) for i, _, _ in rows] + [(4, 0, 0), (None, 1, 1), (5, None, None)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").select("*", F.lit(3).alias("y"), F.lit(4).alias("text"))
    plain = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for module in (toxicity, quality):
        a = module.train(clashing(spark, rows), lab)
        b = module.train(plain.repartition(3), lab.repartition(4))
        assert (a[0] == b[0]).all() and a[1] == b[1]


def test_repeated_ids_give_one_row_and_contradictions_are_label_one(spark):
    rows = [(1, f"text {i}", "s") for i in range(50)] + [(1, None, "s"), (2, "two", "s"), (3, "three", "s")]
    labels = [(1, 0, 0), (1, 1, 1), (1, 0, 0), (2, 0, 0), (3, 0, 0), (None, 1, 1)]
    docs, lab = clashing(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got, share = toxicity.labelled(docs, lab, "toxic", F.lit(True), 100)
    found = sorted((r["y"], r["text"]) for r in got.collect())
    assert [y for y, _ in found] == [0, 0, 1] and found[0][1] == "three" and share == 1.5 / 4
    few, _ = toxicity.labelled(docs, lab, "toxic", F.lit(True), 2)
    assert sorted(r["y"] for r in few.collect()) == [0, 1]


def test_choice_is_the_smallest_hashes(spark):
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).cast("int").alias("toxic"))
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    got, _ = toxicity.labelled(docs, labels, "toxic", F.lit(True), 200)
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 1)
    want = set()
    for y in (0, 1):
        want |= {str(r["doc_id"]) for r in labels.where(F.col("toxic") == y).orderBy(place / float(1 << 63), "doc_id").limit(100).collect()}
    assert {r["text"] for r in got.collect()} == want
