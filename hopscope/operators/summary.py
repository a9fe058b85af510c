"""Longest shortest path summaries (diameter lower bounds).

All of them are aggregates with map-side partial steps: each task sends one
row per source (or a single row), so a source holding most of the rows
costs nothing extra in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopscope.functions.expressions import finite_or_zero


def longest_shortest_path(distances: DataFrame, *, per_source: bool = True,
                          unreachable_as_zero: bool = False) -> DataFrame:
    """Largest finite distance.

    ``per_source=True`` (default): ``(source, lsp)`` over finite rows only,
    one row per source that reached anything (its own 0 counts, so the
    smallest value is 0); unseeded sources get no row.
    ``per_source=False``: one row ``lsp`` over all rows. With
    ``unreachable_as_zero=True`` unreachable rows count as 0, and a result
    with nothing reachable gives 0 rather than NULL.
    """
    d = distances
    if per_source:
        if unreachable_as_zero:
            return d.groupBy("source").agg(F.max(finite_or_zero("dist")).cast("int").alias("lsp"))
        return (
            d.where(F.col("dist").isNotNull())
            .groupBy("source")
            .agg(F.max("dist").cast("int").alias("lsp"))
        )
    if unreachable_as_zero:
        return d.agg(F.coalesce(F.max(finite_or_zero("dist")), F.lit(0)).cast("int").alias("lsp"))
    return d.where(F.col("dist").isNotNull()).agg(F.max("dist").cast("int").alias("lsp"))


def diameter_lower_bound(lsp: DataFrame) -> DataFrame:
    """One row ``diameter_lb``: the largest per-source longest path. Every
    shortest path is a lower bound on the diameter, so the largest one over
    the sources is the best bound they give."""
    return lsp.agg(F.coalesce(F.max("lsp"), F.lit(0)).cast("int").alias("diameter_lb"))


def distance_histogram(distances: DataFrame) -> DataFrame:
    """``(dist, vertices)``: how many (source, vertex) rows sit at each finite
    distance; in a breadth-first run, the updates made by each round."""
    return (
        distances.where(F.col("dist").isNotNull())
        .groupBy("dist")
        .agg(F.count(F.lit(1)).alias("vertices"))
    )
