"""A directed graph laid out for repeated frontier joins.

``prepare_graph`` turns an edge table ``(src, dst)`` into a :class:`HopGraph`:

* edges are deduplicated (hash on ``(src, dst)``, so a hub vertex spreads
  over all partitions instead of landing in one);
* every vertex whose out-degree exceeds ``chunk`` edges is a *hot* vertex and
  its edges are split into ``ceil(degree / chunk)`` salted groups. ``chunk``
  is at least ``|E| / (4 * partitions)``, so there are at most
  ``4 * partitions`` hot vertices: the hot table has a proven size bound and
  is broadcast;
* the salted edges are hash-partitioned on ``(src, salt)``, sorted within
  partitions and cached, planned without adaptive execution so that every
  later join on ``(vertex, salt)`` shuffles only the (small) frontier side
  and merges against the edges without re-sorting them.

Each traversal round therefore reads the edges once, shuffles nothing of
them, and no task holds more than about ``|E| / partitions`` edges of a
single vertex, however skewed the degrees are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import TYPE_CHECKING

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hopscope.plans.session import (
    broadcast_limit,
    default_partitions,
    iteration_settings,
    row_bytes,
    scoped_conf,
)

if TYPE_CHECKING:
    from hopscope.plans.edge_store import EdgeStore

# A vertex is only salted once it has at least this many distinct out-edges,
# whatever the partition count (tiny graphs need no salting).
MIN_CHUNK = 10_000
# Edges per partition of the layout when the partition count is derived from
# the data: aim for EDGES_PER_PARTITION, at most the session's shuffle
# partition count, but never more than MAX_EDGES_PER_PARTITION in one
# partition (a few hundred MB cached), whatever the session says.
EDGES_PER_PARTITION = 32_768
MAX_EDGES_PER_PARTITION = 8_000_000
# Most (source, vertex) rows of traversal state per partition.
MAX_STATE_ROWS_PER_PARTITION = 8_000_000
# State of up to so many sources gets partitions for all that they may reach at once.
FEW_SOURCES = 64
# A hot vertex is cut into chunks of about |E| / (CHUNKS_PER_PARTITION * p)
# edges, so each partition receives several chunks and hashing them spreads
# a hub evenly (the hot table stays within CHUNKS_PER_PARTITION * p rows).
CHUNKS_PER_PARTITION = 4


@dataclass
class HopGraph:
    """Vertex ids are strings to the user. Inside the layout they are longs
    when every id is a canonical decimal integer (``id_type == "long"``):
    hashing, sorting and shuffling 8-byte keys is much cheaper. Frames the
    library hands back always carry string ids."""

    edges: DataFrame            # src, dst (id_type) [+ salt int when hot vertices exist]; distinct (src, dst)
    hot: DataFrame | None       # hot_vertex (id_type), nsalt int; bounded, see prepare_graph
    partitions: int
    num_edges: int
    max_out_degree: int
    max_id_length: int
    chunk: int
    id_type: str = "string"
    store: EdgeStore | None = None  # the edges as a pruned table, if they are kept as one
    _keys: DataFrame | None = field(default=None, repr=False)
    _aliased: DataFrame | None = field(default=None, repr=False)
    _large: dict = field(default_factory=dict, repr=False)
    _approx_vertices: int | None = field(default=None, repr=False)
    _degrees: DataFrame | None = field(default=None, repr=False)
    _reversed: HopGraph | None = field(default=None, repr=False)

    def approx_vertices(self) -> int:
        """Approximate vertex count (HyperLogLog; one aggregate, partial per
        task, no shuffle of the edges)."""
        if self._approx_vertices is None:
            row = self.edges.select(F.explode(F.array("src", "dst")).alias("v")).agg(
                F.approx_count_distinct("v").alias("n")
            ).first()
            self._approx_vertices = int(row["n"])
        return self._approx_vertices

    def large_degrees(self, least: int) -> DataFrame:
        """(d_vertex, deg) of the vertices with more out-edges; computed once for
        each bound, at most |E| / least rows."""
        if least not in self._large:
            deg = self.edges.groupBy(F.col("src").alias("d_vertex")).agg(F.count(F.lit(1)).alias("deg")).where(F.col("deg") > least)
            self._large[least] = deg.persist(StorageLevel.MEMORY_AND_DISK)
        return self._large[least]

    def degrees(self) -> DataFrame:
        """(vertex, outs, ins) of every vertex; computed once."""
        if self._degrees is None:
            one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
            ends = self.edges.select(F.col("src").alias("vertex"), one.alias("outs"), none.alias("ins"))
            ends = ends.union(self.edges.select(F.col("dst").alias("vertex"), none.alias("outs"), one.alias("ins")))
            sums = ends.groupBy("vertex").agg(F.sum("outs").alias("outs"), F.sum("ins").alias("ins"))
            self._degrees = sums.persist(StorageLevel.MEMORY_AND_DISK)
        return self._degrees

    def reversed(self) -> HopGraph:
        """The graph with its edges turned round, laid out in the same way; built once."""
        if self._reversed is None:
            e = self.edges if self.store is None else self.store.scan("in")
            turned = e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
            deg = self.degrees().select(F.col("vertex").alias("src"), F.col("ins").alias("deg"))
            max_deg = int(deg.agg(F.max("deg")).first()[0] or 0)
            edges, hot = lay_out(self.spark, turned, deg, max_deg, self.partitions, self.chunk, self.id_type)
            self._reversed = HopGraph(
                edges=edges, hot=hot, partitions=self.partitions, num_edges=self.num_edges, max_out_degree=max_deg,
                max_id_length=self.max_id_length, chunk=self.chunk, id_type=self.id_type,
            )
        return self._reversed

    def state_partitions(self, sources: int) -> int:
        """Partitions for traversal state of ``sources`` sources that reach the
        whole graph: the layout's count, raised so no state partition holds more
        than ``MAX_STATE_ROWS_PER_PARTITION`` (source, vertex) rows."""
        p = self.partitions
        if sources * 2 * self.num_edges <= p * MAX_STATE_ROWS_PER_PARTITION:
            return p
        return max(p, math.ceil(sources * self.approx_vertices() / MAX_STATE_ROWS_PER_PARTITION))

    def first_partitions(self, sources: int) -> int:
        """Partitions to begin with: room for all that a few sources may reach.
        Many sources may reach little each; their state is counted as it grows."""
        return self.state_partitions(sources) if sources <= FEW_SOURCES else self.partitions

    def partitions_ahead(self, partitions: int, held: int, frontier: DataFrame, frontier_rows: int, groups: int) -> int:
        """Partitions for the state after the next round: as many as now, unless
        the ``held`` rows and those that may come would overfill them; then room
        for twice as many rows is made. A row may come for each edge that leaves
        the frontier, but no more than one for each of ``groups`` (sources, or
        words of them) and vertex. Edges are counted only if plainer bounds are
        over what there is room for."""
        room = partitions * MAX_STATE_ROWS_PER_PARTITION
        bound = held + frontier_rows * self.max_out_degree
        if bound > room:
            bound = min(bound, max(held, groups * self.approx_vertices()))
        if bound > room:
            outs = self.degrees().select(F.col("vertex").alias("d_vertex"), "outs")
            leaving = frontier.join(outs, F.col("vertex") == F.col("d_vertex")).agg(F.sum("outs")).first()[0]
            bound = min(bound, held + int(leaving or 0))
        return partitions if bound <= room else math.ceil(2 * bound / MAX_STATE_ROWS_PER_PARTITION)

    @property
    def spark(self):
        return self.edges.sparkSession

    def internal_id(self, c: Column) -> Column:
        """A user id in the layout's id type; NULL when it cannot be a vertex
        of this graph (a non-canonical number in a numeric graph)."""
        s = c.cast("string")
        if self.id_type == "long":
            return F.when(canonical_long(s), s.try_cast("long"))
        return s

    def internal_values(self, values: list[str]) -> list:
        if self.id_type == "long":
            return [int(v) for v in values if is_canonical_long(v)]
        return list(values)

    @staticmethod
    def public_id(c: Column) -> Column:
        return c.cast("string")

    def aliased_edges(self) -> DataFrame:
        """The edge layout under the alias ``e`` (built once, reused by every
        round's join)."""
        if self._aliased is None:
            self._aliased = self.edges.alias("e")
        return self._aliased

    def edge_pairs(self) -> DataFrame:
        """The distinct edges as ``(src, dst)`` strings."""
        return self.edges.select(self.public_id(F.col("src")).alias("src"), self.public_id(F.col("dst")).alias("dst"))

    def keys(self) -> DataFrame:
        """Vertices with at least one out-edge (adjacency keys), column ``vertex``."""
        if self._keys is None:
            self._keys = self.edges.select("src").distinct().select(self.public_id(F.col("src")).alias("vertex"))
        return self._keys

    def vertices(self) -> DataFrame:
        """All vertices: keys and every neighbour, column ``vertex``."""
        return (
            self.edges.select(F.col("src").alias("v"))
            .union(self.edges.select(F.col("dst").alias("v")))
            .distinct()
            .select(self.public_id(F.col("v")).alias("vertex"))
        )

    def unpersist(self) -> None:
        self.edges.unpersist()
        if self.hot is not None:
            self.hot.unpersist()
        for deg in self._large.values():
            deg.unpersist()
        self._large.clear()
        if self._degrees is not None:
            self._degrees.unpersist()
        if self._reversed is not None:
            self._reversed.unpersist()


def normalize_edges(edges: DataFrame) -> DataFrame:
    """``(src, dst)`` as strings, rows with a missing end dropped."""
    return (
        edges.select(F.col("src").cast("string").alias("src"), F.col("dst").cast("string").alias("dst"))
        .where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    )


def typed_edges(edges: DataFrame) -> DataFrame:
    """``(src, dst)`` as longs if both columns are whole numbers, else as strings."""
    types = dict(edges.dtypes)
    if all(types[c] in ("tinyint", "smallint", "int", "bigint") for c in ("src", "dst")):
        rows = edges.select(F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst"))
        return rows.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    return normalize_edges(edges)


def layout_partitions(num_edges: int, session_partitions: int) -> int:
    """Partition count for a layout of ``num_edges`` edges."""
    target = min(session_partitions, math.ceil(num_edges / EDGES_PER_PARTITION))
    floor = math.ceil(num_edges / MAX_EDGES_PER_PARTITION)
    return max(1, target, floor)


def canonical_long(s: Column) -> Column:
    """True when the string is exactly the decimal text of a long."""
    return F.coalesce(s.try_cast("long").cast("string") == s, F.lit(False))


def is_canonical_long(v: str) -> bool:
    try:
        n = int(v)
    except (TypeError, ValueError):
        return False
    return str(n) == v and -(2 ** 63) <= n < 2 ** 63


def salt_for(dst: str, nsalt: str) -> F.Column:
    """Salt of an edge of a hot vertex: a deterministic hash of its target,
    so a recomputed partition gets exactly the same split."""
    return F.when(F.col(nsalt).isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(F.col(dst)), F.col(nsalt).cast("long")).cast("int")
    )


def prepare_graph(edges: DataFrame, partitions: int | None = None, chunk: int | None = None,
                  numeric_ids: bool | None = None) -> HopGraph:
    """Deduplicate, salt, co-partition and cache an edge table.

    ``partitions`` defaults to one per ``EDGES_PER_PARTITION`` edges, at
    most the session's shuffle partition count (so a small graph does not
    pay for hundreds of near-empty tasks every round) but at least one per
    ``MAX_EDGES_PER_PARTITION`` edges (so a partition stays a few hundred
    MB however large the graph); ``chunk`` (the most edges of one vertex a partition
    takes) defaults to ``max(MIN_CHUNK, ceil(|E| / (4 * partitions)))``, and is
    raised if needed so that the ``|E| / chunk`` possible hot vertices fit
    under the broadcast limit. ``numeric_ids``: ``None`` keeps the ids as
    longs inside the layout when every id is a canonical integer, ``False``
    always keeps strings.
    """
    spark = edges.sparkSession
    uniq = typed_edges(edges).distinct().persist(StorageLevel.MEMORY_AND_DISK)
    deg, stats = degree_statistics(uniq)
    m = stats["m"]
    p = partitions or layout_partitions(m, default_partitions(spark))
    id_type = stats["id_type"] if numeric_ids is not False else "string"
    c = chunk_size(spark, m, p, stats["max_len"], chunk)
    laid_out, hot = lay_out(spark, uniq, deg, stats["max_deg"], p, c, id_type)
    laid_out.count()
    uniq.unpersist()
    return HopGraph(
        edges=laid_out,
        hot=hot,
        partitions=p,
        num_edges=m,
        max_out_degree=stats["max_deg"],
        max_id_length=stats["max_len"],
        chunk=c,
        id_type=id_type,
    )


def degree_statistics(uniq: DataFrame) -> tuple[DataFrame, dict]:
    """Out-degrees of distinct edges, and one row of figures about them."""
    numbers = dict(uniq.dtypes)["src"] == "bigint"
    odd = lambda c: F.lit(False) if numbers else ~canonical_long(F.col(c))
    # Out-degree per vertex: partial counts before the shuffle, so a hub sends
    # one row per map task, not one per edge.
    deg = uniq.groupBy("src").agg(
        F.count(F.lit(1)).alias("deg"),
        F.max(F.length(F.col("dst").cast("string"))).alias("dst_len"),
        F.count_if(odd("dst")).alias("odd_dst"),
    )
    stats = deg.agg(
        F.coalesce(F.sum("deg"), F.lit(0)).alias("m"),
        F.coalesce(F.max("deg"), F.lit(0)).alias("max_deg"),
        F.coalesce(F.greatest(F.max(F.length(F.col("src").cast("string"))), F.max("dst_len")), F.lit(1)).alias("max_len"),
        (F.coalesce(F.sum("odd_dst"), F.lit(0)) + F.count_if(odd("src"))).alias("odd"),
    ).first().asDict()
    stats = {k: int(v) for k, v in stats.items()}
    return deg, stats | {"id_type": "long" if stats["odd"] == 0 else "string"}


def chunk_size(spark, m: int, p: int, max_len: int, chunk: int | None) -> int:
    """Most edges of one vertex in a salted group of a layout in ``p`` partitions."""
    c = chunk or max(MIN_CHUNK, math.ceil(m / (CHUNKS_PER_PARTITION * p)))
    # There are at most m / c hot vertices; keep that many rows within the
    # broadcast limit (never fewer than the default bound allowed), whatever
    # c was asked.
    max_hot = max(CHUNKS_PER_PARTITION * p, broadcast_limit(spark) // row_bytes(1, max_len, fixed_cols=1))
    return max(c, math.ceil(m / max_hot), 1)


def lay_out(spark, uniq: DataFrame, deg: DataFrame, max_deg: int, p: int, c: int, id_type: str) -> tuple[DataFrame, DataFrame | None]:
    """The edges, salted, co-partitioned and persisted (computed when first
    read), and the hot vertices if there are any. ``deg`` has the out-degrees
    over ``c`` at least."""
    typed = uniq.select(F.col("src").cast(id_type).alias("src"), F.col("dst").cast(id_type).alias("dst"))
    hot = None
    if max_deg > c:
        # At most m / c <= p rows: a proven bound, so broadcasting it is safe.
        hot = (
            deg.where(F.col("deg") > c)
            .select(
                F.col("src").cast(id_type).alias("hot_vertex"),
                F.ceil(F.col("deg") / F.lit(c)).cast("int").alias("nsalt"),
            )
            .persist(StorageLevel.MEMORY_AND_DISK)
        )
        salted = typed.join(F.broadcast(hot), typed.src == hot.hot_vertex, "left").select(
            "src", salt_for("dst", "nsalt").alias("salt"), "dst"
        )
        keys = ["src", "salt"]
    else:
        salted = typed
        keys = ["src"]
    with scoped_conf(spark, iteration_settings(p)):
        return salted.repartition(p, *keys).sortWithinPartitions(*keys).persist(StorageLevel.MEMORY_AND_DISK), hot
