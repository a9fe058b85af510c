"""Directed graphs derived from the order tables.

``part_next``: an edge ``p -> q`` when, in one order, the line after a line
of part ``p`` is a line of part ``q`` (``p != q``). ``part_next_r`` keeps
only returned lines (flag ``R``) and a first line of quantity >= 25, which
gives a sparse graph with sinks, unreachable vertices and long paths.

``order_next``: an edge from each order to the same customer's next one (by
date, then key), over all orders: one path a customer, up to some 25 orders
long, with a sink each.

Both ends are reduced to distinct ``(order, line, part)`` before the
self-join, so a repeated ``(order, line)`` pair cannot blow the join up, and
the edges come out distinct. Ids are strings, or longs on demand (``ids``): a
graph is laid out faster from these.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def part_next(spark: SparkSession, sf_dir: str, returned_only: bool = False, ids: str = "string") -> DataFrame:
    li = lineitem(spark, sf_dir)
    first = li
    second = li
    if returned_only:
        first = li.where((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 25))
        second = li.where(F.col("l_returnflag") == "R")
    a = first.select(
        F.col("l_orderkey").alias("ok"), F.col("l_linenumber").alias("ln"), F.col("l_partkey").alias("src_key")
    ).distinct()
    b = second.select(
        F.col("l_orderkey").alias("ok"), (F.col("l_linenumber") - 1).alias("ln"), F.col("l_partkey").alias("dst_key")
    ).distinct()
    return (
        a.join(b, ["ok", "ln"])
        .where(F.col("src_key") != F.col("dst_key"))
        .select(F.col("src_key").cast(ids).alias("src"), F.col("dst_key").cast(ids).alias("dst"))
        .distinct()
    )


def part_next_r(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_next(spark, sf_dir, returned_only=True)


def order_next(spark: SparkSession, sf_dir: str, ids: str = "string") -> DataFrame:
    """Orders without a customer or a key stand alone. A customer's orders are
    ranked in one task; their number does not grow with the table."""
    mine = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_custkey IS NOT NULL AND o_orderkey IS NOT NULL")
    following = o.select(F.col("o_orderkey").alias("src"), F.lead("o_orderkey").over(mine).alias("dst"))
    return following.where("dst IS NOT NULL").select(F.col("src").cast(ids).alias("src"), F.col("dst").cast(ids).alias("dst")).distinct()


def urgent_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source``: the orders of the highest priority."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return o.where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_orderkey").cast("string").alias("source"))


def part_count(spark: SparkSession, sf_dir: str) -> int:
    """Number of parts: the id range ``0 .. N-1`` the samples draw from."""
    return spark.read.parquet(f"{sf_dir}/part.parquet").count()
