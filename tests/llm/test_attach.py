"""Large tables are joined through a shuffle, however small Spark takes them to be."""

import pytest
from pyspark.sql import functions as F

from hopscope.llm import common, filter_audit
from tests.llm.test_runs_and_audit import audit_rows, brute_audit, docs_df


def joins(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line]


@pytest.mark.parametrize("skewed", [False, True])
def test_copies_of_a_large_table_are_not_broadcast(spark, tmp_path, skewed):
    rows = [(3 if skewed and i % 3 else i % 40 if i % 7 else None, i) for i in range(600)]
    table = [(k, f"v{k}") for k in (None, *range(0, 40, 2))]
    spark.createDataFrame(table, "k long, v string").write.parquet(str(tmp_path / "table"))
    small = spark.read.parquet(str(tmp_path / "table"))
    got = common.attach(spark.createDataFrame(rows, "k long, i int"), small, ["k"], 10**9, 40, F.col("i"))
    of = dict(table)
    assert sorted(got.collect(), key=lambda r: r["i"]) == [(k, i, of.get(k)) for k, i in rows]
    assert joins(got) and not any("Broadcast" in x for x in joins(got))


def test_small_table_is_broadcast(spark):
    df, small = spark.range(50).withColumnRenamed("id", "k"), spark.createDataFrame([(4, "four")], "k long, v string")
    got = common.attach(df, small, ["k"], 1, 40)
    assert got.where("v = 'four'").count() == 1 and got.count() == 50
    assert any("Broadcast" in x for x in joins(got))


def test_audit_with_labels_over_the_limit(spark, monkeypatch):
    seen = []

    def watched(*args):
        seen.append(common.attach(*args))
        return seen[-1]

    monkeypatch.setattr(filter_audit, "attach", watched)
    monkeypatch.setattr(common, "BROADCAST_BYTES", 100)
    rows, labels = audit_rows()
    got = filter_audit.audit(docs_df(spark, rows).repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert sorted(tuple(r) for r in got.collect()) == brute_audit(rows, labels)
    assert joins(seen[0]) and not any("Broadcast" in x for x in joins(seen[0]))


def test_labels_count_as_many_bytes_as_they_take(spark):
    # 200,000 labelled ids take some 25 MB in a broadcast.
    labels = spark.range(200_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    counts = filter_audit.failure_counts(docs_df(spark, [(1, "a text", "s")]), labels)
    plan = counts._jdf.queryExecution().sparkPlan().toString()
    met = [line for line in plan.splitlines() if "LeftOuter" in line]
    assert met and not any("Broadcast" in line for line in met)


def test_audit_workers_give_freed_memory_back(spark, monkeypatch):
    told = []
    monkeypatch.setattr(filter_audit, "lean", lambda run: told.append(run) or common.lean(run))
    assert filter_audit._failing(docs_df(spark, [(1, "a text", "s")]), "source").count() == 1 and len(told) == 1
