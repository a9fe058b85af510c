"""A corpus in five stages, from ``documents`` to binary token files.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; ``run`` writes each result as Parquet in the shared folder and reads it
again. All stages but the last return the columns of ``documents``; the last
returns what the token files hold (doc_id, start, n_tokens, ids_crc32).

The stages' defined results are those of their operators: null and empty texts
stay unless a stage's model or rule rejects them, and empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hopscope.llm import decontaminate, mixture, order_minhash, rans, toxicity
from hopscope.llm.common import fresh_path, table
from hopscope.llm.queries import fold, tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; all of them if there are no labels of
    both kinds to learn from."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), train_rows=fold(F.col("__id"), 5) != 0)
    if not model[0].any():
        return docs
    # The score's name is longer than any column's; whole rows pass, each text once.
    name = "toxic".ljust(1 + max(map(len, docs.columns)), "_")
    return toxicity.score(docs, model, name).where(F.col(name) < 0.5).drop(name)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return order_minhash.deduplicate(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes."""
    return mixture.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the token files, read back from them."""
    return rans.token_files(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_copies),
    ("benchmark_decontamination", drop_leaks),
    ("source_mixing", mix_sources),
    ("token_output", write_tokens),
]

#: The classifier, the alignments and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
