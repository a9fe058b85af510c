"""Edge table <-> adjacency lists.

Adjacency rows are ``(vertex, part, neighbors array<string>)``; duplicate
edges and self-loops are kept. A vertex's sorted neighbours are cut into parts
of ``MAX_LIST`` (part 0 holds the first of them, and so on), so a row stays far
below the size that one may have and no task builds a hub's whole list. The
parts depend on the edges alone, not on the session. The adjacency readers
treat several rows of one vertex as the union of their lists.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hopscope.plans.graph import normalize_edges
from hopscope.plans.session import default_partitions, fits_broadcast, iteration_settings, materialize, row_bytes, scoped_conf

#: Neighbours of one adjacency row.
MAX_LIST = 10_000
#: Neighbours that a task takes, once they are counted.
PER_TASK = 500_000
#: Partitions for edges that are not counted yet; small ones are merged, up to so many bytes,
#: and files are read in pieces of as many.
UNCOUNTED, PIECE_BYTES = 240, 8 << 20


def _uncounted(spark: SparkSession) -> dict[str, str]:
    """Settings under which a task takes a small piece, whatever the input's size."""
    return {
        "spark.sql.shuffle.partitions": str(max(UNCOUNTED, default_partitions(spark))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PIECE_BYTES),
        "spark.sql.files.maxPartitionBytes": str(PIECE_BYTES),
    }


def tasks_for(neighbors: int) -> int:
    return max(1, math.ceil(neighbors / PER_TASK))


def _placed(pairs: DataFrame, partitions: int) -> DataFrame:
    """``pairs`` with ``at``: the copies that stand before the pair in its
    vertex's sorted list. Ranges of (src, dst) are counted first, so a hub's
    pairs are ranked in as many tasks as they fill."""
    ranged = pairs.repartitionByRange(partitions, "src", "dst").withColumn("range", F.spark_partition_id())
    ranged, _ = materialize(ranged)
    sums = ranged.groupBy("src", "range").agg(F.sum("copies").alias("n"))
    before = sums.select("src", "range", (F.sum("n").over(Window.partitionBy("src").orderBy("range")) - F.col("n")).alias("before"))
    inside = F.sum("copies").over(Window.partitionBy("src", "range").orderBy("dst")) - F.col("copies")
    return ranged.join(before, ["src", "range"]).withColumn("at", F.col("before") + inside).drop("before", "range")


def to_adjacency(edges: DataFrame, *, max_list: int = MAX_LIST, partitions: int | None = None) -> DataFrame:
    """``(vertex, part, neighbors)`` from ``(src, dst)`` edges; ``max_list`` is
    the most neighbours of a row and is kept exactly.

    Graph statistics (one row) are the only values brought to the driver.
    The result is checkpointed: the input is computed once.
    """
    spark = edges.sparkSession
    # Identical edges collapse to (src, dst, copies) before any list is built,
    # so even one edge repeated a billion times is a single row. The reduced
    # pairs are cached for the statistics pass and the list building.
    with scoped_conf(spark, _uncounted(spark)):
        pairs = (
            normalize_edges(edges)
            .groupBy("src", "dst")
            .agg(F.count(F.lit(1)).alias("copies"))
            .persist(StorageLevel.MEMORY_AND_DISK)
        )
        deg = pairs.groupBy("src").agg(F.sum("copies").alias("deg"))
        hub = F.col("deg") > max_list
        stats = deg.agg(
            F.count_if(hub).alias("n"),
            F.coalesce(F.max(F.when(hub, F.length("src"))), F.lit(1)).alias("l"),
            F.coalesce(F.sum("deg"), F.lit(0)).alias("m"),
        ).first()
    p = partitions or tasks_for(stats["m"])
    # Partitions of a counted size, not merged by their packed bytes: lists of many short ids pack well.
    with scoped_conf(spark, iteration_settings(p)):
        hubs = deg.where(hub).select(F.col("src").alias("hub"))
        parts = pairs.withColumn("part", F.lit(0).cast("long"))
        if stats["n"]:
            small = fits_broadcast(spark, stats["n"], row_bytes(1, stats["l"]))
            hubs = F.broadcast(hubs) if small else hubs.hint("merge")
            hot = _placed(pairs.join(hubs, pairs.src == hubs.hub, "left_semi"), p)
            last = F.floor((F.col("at") + F.col("copies") - 1) / max_list)
            hot = hot.withColumn("part", F.explode(F.sequence(F.floor(F.col("at") / max_list), last)))
            lo = F.greatest(F.col("at"), F.col("part") * max_list)
            hi = F.least(F.col("at") + F.col("copies"), (F.col("part") + 1) * max_list)
            hot = hot.withColumn("copies", hi - lo).select("src", "dst", "copies", "part")
            parts = parts.join(hubs, parts.src == hubs.hub, "left_anti").unionByName(hot)
        lists = parts.groupBy("src", "part").agg(
            F.sort_array(F.flatten(F.collect_list(F.array_repeat(F.col("dst"), F.col("copies").cast("int"))))).alias("neighbors")
        ).select(F.col("src").alias("vertex"), F.col("part").cast("int").alias("part"), "neighbors")
        adjacency, _ = materialize(lists)
    pairs.unpersist()
    return adjacency


def to_edges(adjacency: DataFrame) -> DataFrame:
    """``(src, dst)``: one row per listed neighbour (an empty list gives no
    rows). Several rows of one vertex contribute the union of their lists."""
    return adjacency.select(
        F.col("vertex").cast("string").alias("src"), F.explode("neighbors").alias("dst")
    )


def adjacency_text(adjacency: DataFrame) -> DataFrame:
    """``(vertex, neighbors)`` with the list rendered as ``n1,n2,...``."""
    return adjacency.select("vertex", F.array_join("neighbors", ",").alias("neighbors"))
