"""Blocks of the mix grow with its shards."""

from pyspark.sql import functions as F

from hopscope.llm import mixture


def test_many_shards_get_a_like_load(spark, monkeypatch):
    monkeypatch.setattr(mixture, "BLOCKS", 16)
    rows = [(i, " ".join(["w"] * (1 + i % 3)), "ab"[i % 2]) for i in range(12_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixture.plan_mix(docs, shard_words=400)
    loads = out.select("__size", F.explode("__shards").alias("shard")).groupBy("shard").agg(F.sum("__size").alias("words")).collect()
    shards = -(-24_000 // 400)
    assert len(loads) == shards
    mean = sum(r["words"] for r in loads) / shards
    assert max(r["words"] for r in loads) < 2 * mean and min(r["words"] for r in loads) > 0.3 * mean
