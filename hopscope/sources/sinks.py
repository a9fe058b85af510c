"""Writers for adjacency lists, distances, state and summaries.

Every writer is a distributed ``DataFrame.write``; nothing is gathered on the
driver. ``mode`` defaults to ``overwrite``. Paths may be any filesystem URI
Spark can write (local, HDFS, S3, ...).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopscope.functions.expressions import KEY_SEPARATOR, NO_NEIGHBOURS, null_to_infinity


def adjacency_lines(adjacency: DataFrame) -> DataFrame:
    """``value`` = ``vertex<TAB>n1,n2,...``."""
    return adjacency.select(
        F.concat_ws("\t", F.col("vertex"), F.array_join("neighbors", ",")).alias("value")
    )


def write_adjacency(adjacency: DataFrame, path: str, fmt: str = "text", mode: str = "overwrite") -> None:
    if fmt == "text":
        adjacency_lines(adjacency).write.mode(mode).text(path)
    elif fmt == "parquet":
        adjacency.select(*[c for c in ("vertex", "part", "neighbors") if c in adjacency.columns]).write.mode(mode).parquet(path)
    else:
        raise ValueError(f"unknown adjacency format {fmt!r}")


def distance_lines(distances: DataFrame, with_source: bool = True, record: bool = False) -> DataFrame:
    """``value`` = ``(source,vertex,dist)`` or ``(vertex,dist)``, infinity
    written as 2147483647; ``record`` puts the word ``Distance`` before."""
    parts = ([F.col("source")] if with_source else []) + [F.col("vertex"), null_to_infinity("dist").cast("string")]
    return distances.select(F.concat(F.lit("Distance(" if record else "("), F.concat_ws(",", *parts), F.lit(")")).alias("value"))


def write_distances(distances: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                    with_source: bool = True, record: bool = False) -> None:
    """``parquet`` / ``csv`` keep NULL for unreachable; ``text`` writes tuples or records."""
    if fmt == "parquet":
        distances.write.mode(mode).parquet(path)
    elif fmt == "csv":
        distances.write.mode(mode).csv(path)
    elif fmt == "text":
        distance_lines(distances, with_source, record).write.mode(mode).text(path)
    else:
        raise ValueError(f"unknown distance format {fmt!r}")


def state_lines(distances: DataFrame, adjacency: DataFrame, single_source: bool = False,
                stop_at_other_sources: bool = False) -> DataFrame:
    """``value`` = ``vertex"to"source<TAB>n1,n2 dist`` (or ``vertex<TAB>...``
    for one source). Each distance row carries its vertex's adjacency; a
    vertex without one gets the word ``null``; infinity is 2147483647.
    A vertex listed on several adjacency rows writes several state lines.
    With ``stop_at_other_sources`` a source's list stands under its own key
    alone, as it does not expand in another source's traversal."""
    adj = adjacency.select(F.col("vertex").alias("_v"), F.array_join("neighbors", ",").alias("_nb"))
    j = distances.join(adj, distances.vertex == adj._v, "left")
    if stop_at_other_sources:
        stops = distances.select(F.col("source").alias("_stop")).distinct()
        j = j.join(stops, (F.col("vertex") == F.col("_stop")) & (F.col("vertex") != F.col("source")), "left")
        j = j.withColumn("_nb", F.when(F.col("_stop").isNull(), F.col("_nb")))
    key = F.col("vertex") if single_source else F.concat(F.col("vertex"), F.lit(KEY_SEPARATOR), F.col("source"))
    nb = F.coalesce(F.col("_nb"), F.lit(NO_NEIGHBOURS))
    return j.select(
        F.concat(key, F.lit("\t"), nb, F.lit(" "), null_to_infinity("dist").cast("string")).alias("value")
    )


def write_state(distances: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                adjacency: DataFrame | None = None, single_source: bool = False,
                stop_at_other_sources: bool = False) -> None:
    """Save traversal state for a later resume: parquet
    ``(source, vertex, dist)``, or the text layout (needs ``adjacency``)."""
    if fmt == "parquet":
        distances.select("source", "vertex", "dist").write.mode(mode).parquet(path)
    elif fmt == "text":
        if adjacency is None:
            raise ValueError("text state needs the adjacency lists")
        state_lines(distances, adjacency, single_source, stop_at_other_sources).write.mode(mode).text(path)
    else:
        raise ValueError(f"unknown state format {fmt!r}")


def summary_lines(lsp: DataFrame) -> DataFrame:
    """``value`` = ``source<TAB>lsp``, or just ``lsp`` without a source column."""
    if "source" in lsp.columns:
        return lsp.select(F.concat_ws("\t", F.col("source"), F.col("lsp").cast("string")).alias("value"))
    return lsp.select(F.col("lsp").cast("string").alias("value"))


def write_summary(lsp: DataFrame, path: str, fmt: str = "text", mode: str = "overwrite") -> None:
    if fmt == "text":
        summary_lines(lsp).write.mode(mode).text(path)
    elif fmt == "parquet":
        lsp.write.mode(mode).parquet(path)
    else:
        raise ValueError(f"unknown summary format {fmt!r}")
