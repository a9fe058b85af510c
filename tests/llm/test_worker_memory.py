"""Python workers, which wait for tasks beside the executor's heap, keep little memory."""

import gc
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from hopscope.llm import common, decontaminate, order_minhash, rans, toxicity
from hopscope.llm.queries import tokenizer_path
from tests.llm.test_operators import docs_df
from tests.llm.test_texts_sent_once import sent  # noqa: F401

TEXT = " ".join(f"word{i} thing{i % 7}" for i in range(60))


def own_mb() -> float:
    with open("/proc/self/smaps_rollup") as f:
        return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", f.read()))) / 1024


def test_what_a_task_freed_goes_back_when_it_ends():
    def run(batches):
        for batch in batches:
            held = [bytes(2_000) for _ in range(100_000)]
            arrow = pa.concat_arrays([pa.array(np.zeros(1 << 20)) for _ in range(4)])
            yield batch
            held, arrow = held[-1:], None
            kept.append(held)  # the last one stays and keeps the heap's end where it is

    kept, before = [], own_mb()
    list(common.lean(run)(iter([pa.record_batch({"a": [1]})])))
    gc.collect()
    assert own_mb() - before < 60  # 190 MB more if nothing is given back


def test_what_a_failing_task_freed_goes_back(monkeypatch):
    told = []
    monkeypatch.setattr(common, "give_back", lambda: told.append(1))

    def run(batches):
        yield next(batches)
        raise ValueError

    try:
        list(common.lean(run)(iter([1])))
    except ValueError:
        told.append(2)
    assert told == [1, 2]


def test_every_stage_gives_back(spark, monkeypatch, tmp_path):
    from pyspark.sql.classic.dataframe import DataFrame

    seen, whole = [], DataFrame.mapInArrow
    monkeypatch.setattr(DataFrame, "mapInArrow", lambda self, f, *a, **b: seen.append(f.__qualname__) or whole(self, f, *a, **b))
    docs = docs_df(spark, [(i, TEXT + f" {i % 2}", "s") for i in range(8)])
    toxicity.score(docs, toxicity.Model(*toxicity.fit([], [], np.array([]), 0.5), 0.04, 0)).count()
    assert order_minhash.deduplicate(docs).count() >= 1
    benchmark = spark.createDataFrame([(1, TEXT)], "item_id long, text string")
    assert decontaminate.decontaminate(docs, benchmark).count() == 0
    assert rans.token_files(docs, tokenizer_path()).count() == 8
    assert len(seen) >= 5 and set(seen) == {"lean.<locals>.task"}


def test_texts_of_copies_and_leaks_are_sent_in_small_batches(spark, sent):  # noqa: F811
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs = docs_df(spark, [(i, TEXT + f" {i % 2}", "s") for i in range(8)])
    order_minhash.near_duplicates(docs)
    decontaminate.decontaminate(docs, spark.createDataFrame([(1, TEXT)], "item_id long, text string"))
    assert {int(n) for columns, n in sent if {"text", "ta"} & set(columns)} == {common.BATCH_ROWS}
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_kept_rows_of_leaks_do_not_change(spark):
    docs = docs_df(spark, [(1, TEXT, "s"), (1, "other", "s"), (2, "other", "s"), (None, TEXT, "s"), (None, "own", "s"), (3, None, "s")])
    kept = decontaminate.decontaminate(docs, spark.createDataFrame([(1, TEXT)], "item_id long, text string"))
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.select("doc_id", F.col("text")).collect()) == [(0, "own"), (2, "other"), (3, "")]
