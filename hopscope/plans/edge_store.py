"""Edges as a table in buckets, of which a round reads only those it needs.

``write_edge_store`` writes the distinct edges twice: under ``out`` in buckets
by the hash of ``src``, under ``in`` in buckets by the hash of ``dst``. Each
bucket is a folder, its files sorted by that end, and a bucket with more than
``EDGES_PER_FILE`` edges is split over files by the hash of the other end, so a
hub's edges are read by as many tasks as they fill. ``degrees`` holds the
out-degrees over ``MIN_CHUNK``. The record ``store.json``, written last, makes
the store whole; without it the folder is not opened.

``open_graph`` gives a :class:`HopGraph` over a store. Its round loop asks which
buckets a frontier touches (a bitmap that the round's own job observes). While
they are few and the frontier is small, the frontier is broadcast to a scan of
those buckets' files alone. Only the first round that needs most of the buckets
lays the edges out in memory, as :func:`prepare_graph` does at once.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hopscope.plans.files import Folder
from hopscope.plans.graph import (
    MIN_CHUNK,
    HopGraph,
    chunk_size,
    degree_statistics,
    lay_out,
    layout_partitions,
    typed_edges,
)
from hopscope.plans.session import default_partitions

EDGES_PER_BUCKET = 1_000_000
MIN_BUCKETS, MAX_BUCKETS = 16, 4096
EDGES_PER_FILE = 8_000_000


def bucket_of(vertex: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(vertex), F.lit(buckets)).cast("int")


@dataclass
class EdgeStore:
    spark: SparkSession
    path: str
    buckets: int
    num_edges: int
    max_out_degree: int
    max_id_length: int
    id_type: str

    def _all(self, side: str) -> DataFrame:
        return self.spark.read.schema(f"src {self.id_type}, dst {self.id_type}, bucket int").parquet(f"{self.path}/{side}")

    def scan(self, side: str = "out", buckets: list[int] | None = None) -> DataFrame:
        """(src, dst, bucket) of the given buckets; all of them by default."""
        df = self._all(side)
        return df if buckets is None else df.where(F.col("bucket").isin(sorted(buckets)))

    def degrees(self) -> DataFrame:
        """(src, deg) of the vertices with more than MIN_CHUNK out-edges."""
        return self.spark.read.schema(f"src {self.id_type}, deg long").parquet(f"{self.path}/degrees")

    def touched(self, vertices: DataFrame, column: str) -> list[int]:
        """The buckets of some vertices: at most MAX_BUCKETS numbers."""
        return [r[0] for r in vertices.select(bucket_of(column, self.buckets)).distinct().collect()]


def bitmap_words(buckets: int) -> int:
    return -(-buckets // 64)


def bitmap_columns(vertex: str, buckets: int) -> list[Column]:
    """Aggregates that give, as longs, a bitmap of the vertices' buckets."""
    b = bucket_of(vertex, buckets)
    one = F.lit(1).cast("long")
    return [F.bit_or(F.when(F.floor(b / 64) == w, F.call_function("shiftleft", one, b % 64)).otherwise(F.lit(0).cast("long"))).alias(f"b{w}") for w in range(bitmap_words(buckets))]


def buckets_in(words: list[int | None]) -> list[int]:
    return [64 * w + i for w, bits in enumerate(words) for i in range(64) if (bits or 0) >> i & 1]


def _written(edges: DataFrame, by: str, other: str, buckets: int, path: str, per_file: int, partitions: int) -> None:
    rows = edges.withColumn("bucket", bucket_of(by, buckets))
    # One count a bucket.
    large = [(r["bucket"], -(-r["n"] // per_file)) for r in rows.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > per_file).collect()]
    salt = F.lit(0)
    if large:
        pieces = F.create_map(*[F.lit(x) for pair in large for x in pair])[F.col("bucket")]
        salt = F.when(pieces.isNotNull(), F.pmod(F.xxhash64(other), pieces).cast("int")).otherwise(0)
    rows = rows.withColumn("salt", salt).repartition(partitions, "bucket", "salt").sortWithinPartitions("bucket", by)
    rows.drop("salt").write.mode("overwrite").partitionBy("bucket").parquet(path)


def write_edge_store(edges: DataFrame, path: str, buckets: int | None = None, per_file: int = EDGES_PER_FILE) -> EdgeStore:
    """Write the distinct edges (src, dst) under ``path`` and open them.

    An earlier store at ``path`` is taken apart first: its record goes before
    its files do.
    """
    spark = edges.sparkSession
    folder = Folder(spark, path)
    if folder.exists("store.json"):
        folder.delete("store.json")
    uniq = typed_edges(edges).distinct().persist(StorageLevel.MEMORY_AND_DISK)
    try:
        deg, stats = degree_statistics(uniq)
        m = stats["m"]
        if buckets is None:
            buckets = min(MAX_BUCKETS, max(MIN_BUCKETS, 1 << math.ceil(math.log2(max(1, m / EDGES_PER_BUCKET)))))
        if not 0 < buckets <= MAX_BUCKETS:
            raise ValueError(f"buckets must be 1 to {MAX_BUCKETS}")
        id_type = stats["id_type"]
        typed = uniq.select(F.col("src").cast(id_type).alias("src"), F.col("dst").cast(id_type).alias("dst"))
        partitions = max(default_partitions(spark), math.ceil(m / per_file))
        _written(typed, "src", "dst", buckets, folder.uri("out"), per_file, partitions)
        _written(typed, "dst", "src", buckets, folder.uri("in"), per_file, partitions)
        deg.where(F.col("deg") > MIN_CHUNK).select(F.col("src").cast(id_type).alias("src"), "deg").write.mode("overwrite").parquet(folder.uri("degrees"))
    finally:
        uniq.unpersist()
    folder.commit_json("store.json", {"buckets": buckets, "num_edges": m, "max_out_degree": stats["max_deg"], "max_id_length": stats["max_len"], "id_type": id_type})
    return open_edge_store(spark, path)


def open_edge_store(spark: SparkSession, path: str) -> EdgeStore:
    folder = Folder(spark, path)
    if not folder.exists("store.json"):
        raise FileNotFoundError(f"no whole edge store at {path}")
    return EdgeStore(spark, folder.path, **folder.read_json("store.json"))


def open_graph(spark: SparkSession, path: str, partitions: int | None = None, chunk: int | None = None) -> HopGraph:
    """The graph of a store. Nothing of its edges is read until a round needs them."""
    store = open_edge_store(spark, path)
    m = store.num_edges
    p = partitions or layout_partitions(m, default_partitions(spark))
    c = chunk_size(spark, m, p, store.max_id_length, max(chunk, MIN_CHUNK) if chunk else None)
    edges, hot = lay_out(spark, store.scan().select("src", "dst"), store.degrees(), store.max_out_degree, p, c, store.id_type)
    return HopGraph(
        edges=edges, hot=hot, partitions=p, num_edges=m, max_out_degree=store.max_out_degree,
        max_id_length=store.max_id_length, chunk=c, id_type=store.id_type, store=store,
    )
