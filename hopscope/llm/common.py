"""Helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words everywhere in this package; ``bytes.split()`` cuts UTF-8 text at the same characters.
WORD = r"[^\x20\x09-\x0D]+"

#: The most bytes of a frame that is broadcast; a larger one is joined through a shuffle.
BROADCAST_BYTES = 16 << 20

#: Most texts that are sent to a Python worker at once where a step says so: both its
#: memory and the executor's buffers outside the heap hold whole batches.
BATCH_ROWS = 2_000
SMALL_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)}


def give_back() -> None:
    """Return freed memory, which allocators keep, to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, so that a Python worker keeps little when its task
    ends: it waits for other tasks, beside those that need the executor's memory."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a plain ``local[...]`` session may go without; it gets a temporary
    folder, which is then set as the session's checkpoint folder.
    """
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="hopscope-"))
    return sc.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts the
    lineage, survives the loss of executors and is computed once."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def attach(df: DataFrame, table: DataFrame, on: list[str], rows: int, row_bytes: int = 200, salt: Column | None = None, salts: int = 32) -> DataFrame:
    """Left join of ``df`` with ``table``, which has one row per key (null keys meet).

    A table whose ``rows * row_bytes`` stay below BROADCAST_BYTES is broadcast.
    A larger one is joined through a shuffle, each of its rows copied to
    ``salts`` partitions, so that a key with a third of ``df`` is spread too.
    Spark would judge the copies by the table's files, which may be small, and
    broadcast them all; the hint keeps them out of the driver.
    """
    match = None
    small = table.select([F.col(c).alias(f"__k_{c}") if c in on else F.col(c) for c in table.columns])
    for c in on:
        same = F.col(c).eqNullSafe(F.col(f"__k_{c}"))
        match = same if match is None else match & same
    if rows * row_bytes <= BROADCAST_BYTES:
        return df.join(F.broadcast(small), match, "left").drop(*[f"__k_{c}" for c in on])
    spread = df.withColumn("__salt", F.pmod(salt if salt is not None else F.xxhash64(*df.columns), F.lit(salts)).cast("int"))
    copies = small.withColumn("__k_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    return spread.join(copies, match & (F.col("__salt") == F.col("__k_salt")), "left").drop("__salt", "__k_salt", *[f"__k_{c}" for c in on])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
