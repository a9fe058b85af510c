"""Session-level helpers: where checkpoints go, scoped SQL settings, and the
size check every explicit broadcast in the library goes through."""

from __future__ import annotations

import contextlib
import re
import tempfile
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_SIZE_UNITS = {
    "b": 1,
    "k": 1 << 10, "kb": 1 << 10,
    "m": 1 << 20, "mb": 1 << 20,
    "g": 1 << 30, "gb": 1 << 30,
    "t": 1 << 40, "tb": 1 << 40,
}


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder of this session.

    Uses the folder already set on the context, else ``spark.checkpoint.dir``
    from the configuration. Only a local-mode session (tests, single-node
    runs) without either gets a private temporary folder; on a cluster an
    unset folder is an error, because executor-local storage does not
    survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: point it at shared storage "
                "(HDFS, S3, ...) before running iterative graph jobs"
            )
        configured = tempfile.mkdtemp(prefix="hopscope-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


@contextlib.contextmanager
def scoped_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Set SQL settings for the duration of a block, then restore them."""
    saved = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def iteration_settings(partitions: int) -> dict[str, str]:
    """Settings for the round loop of a traversal.

    The loop keeps its state hash-partitioned on (source, vertex) across
    rounds so that the anti-join against everything already visited never
    reshuffles it. Adaptive execution hides that partitioning from
    checkpoints and caches, so the loop plans its (small, per-round) joins
    without it and handles skew by explicit salting instead.
    """
    return {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": str(partitions),
    }


def default_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def parse_bytes(text: str | None) -> int:
    if text is None:
        return 0
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", str(text))
    if not m:
        return 0
    n, unit = int(m.group(1)), m.group(2).lower()
    return n * _SIZE_UNITS.get(unit or "b", 1)


def broadcast_limit(spark: SparkSession) -> int:
    """Largest side, in bytes, the library is willing to broadcast: the
    session's auto-broadcast threshold (0 when broadcasting is disabled)."""
    limit = parse_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760b"))
    return max(limit, 0)


def fits_broadcast(spark: SparkSession, rows: int, bytes_per_row: int) -> bool:
    """True when ``rows`` rows of at most ``bytes_per_row`` bytes each (an
    upper bound the caller has proven) fit under the broadcast limit."""
    limit = broadcast_limit(spark)
    return limit > 0 and rows * bytes_per_row <= limit


def row_bytes(string_cols: int, max_len: int, fixed_cols: int = 0) -> int:
    """Upper bound of one row in a broadcast hash relation: 8-byte slots,
    strings rounded up to 8 bytes, times two for the hash table around it."""
    per_string = 8 + ((max_len + 7) // 8) * 8
    return 2 * (8 + 8 * fixed_cols + string_cols * per_string)


def materialize(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` computed once and kept in the checkpoint folder, and its row count."""
    return materialize_observed(df)[:2]


def materialize_observed(df: DataFrame, metrics: Callable[[Callable[[str], str]], list[Column]] | None = None) -> tuple[DataFrame, int, dict]:
    """Compute ``df`` once, write it to the reliable checkpoint folder, and
    return the checkpointed frame with its row count and the further ``metrics``,
    named aggregates (a function that is told each column's temporary name).

    The eager checkpoint computes the plan a single time while writing it;
    the row count is an observed metric of that same job, so no second pass
    runs. The checkpoint keeps the frame's partitioning and ordering (when
    planned without adaptive execution), and survives the loss of executors.

    Columns pass through temporary names so that every returned frame owns
    fresh attributes: frames that descend from one another would otherwise
    share attribute ids, which breaks the partitioning recorded by the
    checkpoint and unions of such frames.
    """
    checkpoint_dir(df.sparkSession)
    cols = df.columns
    staged = df.select([F.col(c).alias(f"__m{i}") for i, c in enumerate(cols)])
    obs = Observation()
    more = metrics(lambda c: f"__m{cols.index(c)}") if metrics else []
    saved = staged.observe(obs, F.count(F.lit(1)).alias("rows"), *more).checkpoint(eager=True)
    out = saved.select([F.col(f"__m{i}").alias(c) for i, c in enumerate(cols)])
    return out, int(obs.get["rows"]), obs.get
