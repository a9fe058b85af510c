"""Texts go to Python workers once and in small batches, whatever the other columns are."""

import zlib

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from hopscope.llm import rans, toxicity
from hopscope.llm.queries import tokenizer_path
from tests.llm.test_clashing_names import clashing, texts
from tests.llm.test_operators import docs_df


@pytest.fixture()
def sent(monkeypatch):
    """The columns and the batch size of each frame that goes to Python workers."""
    from pyspark.sql.classic.dataframe import DataFrame

    seen, whole = [], DataFrame.mapInArrow

    def spy(self, *args, **options):
        seen.append((self.columns, self.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")))
        return whole(self, *args, **options)

    monkeypatch.setattr(DataFrame, "mapInArrow", spy)
    return seen


def test_pipeline_sends_each_text_once(spark, sent, tmp_path):
    rows = texts(200)
    docs = clashing(spark, rows).withColumn("odd.`name", F.lit(1))
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 != 0]
    spark.createDataFrame([(i, int(i % 4 == 0)) for i in held], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, str(tmp_path))
    assert len(sent[-1][0]) == len(docs.columns)
    assert kept.columns == docs.columns and kept.schema["odd.`name"].dataType == docs.schema["odd.`name"].dataType
    got = kept.collect()
    assert all(r["n"] == "own n" and r["odd.`name"] == 1 for r in got)
    assert {(r["doc_id"], r["text"], r["source"]) for r in got} == {r for r in rows if r[0] % 4}


def test_score_may_take_the_name_of_the_text(spark):
    model = toxicity.Model(*toxicity.fit([], [], np.array([]), 0.5), 0.04, 0)
    got = toxicity.score(spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string"), model, "text")
    assert got.columns == ["doc_id", "text"] and {r["text"] for r in got.collect()} == {0.5}


def test_tokens_are_sent_in_small_batches(spark, sent, tmp_path):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    rans.write_tokens(docs_df(spark, [(1, "one", "s")]), tokenizer_path(), f"file://{tmp_path}/t", partitions=1)
    assert int(sent[-1][1]) == rans.BATCH_ROWS and spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
