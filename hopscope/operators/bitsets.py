"""Traversals from many sources at once, 64 of them to a long.

The row form of :mod:`hopscope.operators.traversal` keeps a row for each (source,
vertex). Here a row is (word, vertex, bits): bit b says that source b of that
word has reached the vertex. A round sends the bits of the frontier along the
out-edges, merges them by ``bit_or`` per (word, vertex) before and after the
shuffle, and takes away what the vertex had already: candidates and the layers of
visited state are partitioned alike, so their union is grouped in place, without
a shuffle of the state, to ``bits & ~seen``. What is left is the next frontier,
and all its bits have the round's distance.

1,000 sources cost 16 rows a vertex instead of 1,000, in frontier, shuffle and
state, and a hub that all of them reach is expanded by 16 rows. Distances are
written out as (source, vertex, dist) rows only when they are asked for; the
longest path per source needs a merged word for each round alone.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopscope.operators.traversal import (
    DEFAULT_COMPACT_EVERY,
    SourceSet,
    _edges_near,
    _internal_sources,
    _side,
    log_round,
    source_set,
)
from hopscope.plans.generations import tail_to_merge
from hopscope.plans.graph import HopGraph
from hopscope.plans.session import fits_broadcast, iteration_settings, materialize, materialize_observed, row_bytes, scoped_conf

WORD_BITS = 64
#: Sources that are numbered in one task.
NUMBERED = 1 << 20


def _bit(number: str) -> F.Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.col(number))


def _numbered(graph: HopGraph, ss: SourceSet) -> DataFrame:
    """(source, word, bit), ids in the layout's type; words of up to 64 sources."""
    parts = max(1, math.ceil(ss.count / NUMBERED))
    ids = _internal_sources(graph, ss).repartition(parts, "source").sortWithinPartitions("source")
    ids = ids.withColumn("number", F.monotonically_increasing_id())
    at = F.col("number")
    return materialize(ids.select("source", F.floor(at / WORD_BITS).cast("long").alias("word"), F.pmod(at, F.lit(WORD_BITS)).cast("int").alias("bit")))[0]


@dataclass
class BitTraversal:
    """``rounds``: (frame (word, vertex, bits), distance) of each round that
    reached something, the seeds first. ``stats``: (round, updated (source,
    vertex) pairs), as the row form counts them."""

    graph: HopGraph
    sources: SourceSet
    numbered: DataFrame
    rounds: list[tuple[DataFrame, int]]
    stats: list[tuple[int, int]]
    converged: bool

    def _written_out(self, rows: DataFrame) -> DataFrame:
        """Rows with word and bits, one for each bit that is set, with its source."""
        set_bits = F.filter(F.sequence(F.lit(0), F.lit(WORD_BITS - 1)), lambda i: F.call_function("getbit", F.col("bits"), i) == 1)
        each = rows.withColumn("bit", F.explode(set_bits)).drop("bits")
        ids = _side(self.graph.spark, self.numbered, self.sources.count, row_bytes(1, self.sources.max_len, fixed_cols=2))
        return each.join(ids, ["word", "bit"]).withColumn("source", self.graph.public_id(F.col("source"))).drop("word", "bit")

    @property
    def distances(self) -> DataFrame:
        """(source, vertex, dist) of every reached pair."""
        rows = functools.reduce(DataFrame.union, [df.withColumn("dist", F.lit(d).cast("int")) for df, d in self.rounds])
        return self._written_out(rows).select("source", self.graph.public_id(F.col("vertex")).alias("vertex"), "dist")

    def longest(self) -> DataFrame:
        """(source, lsp): the last round that holds the source's bit. A row for
        each word and round is made, none for a pair."""
        rows = functools.reduce(DataFrame.union, [df.groupBy("word").agg(F.bit_or("bits").alias("bits")).withColumn("dist", F.lit(d).cast("int")) for df, d in self.rounds])
        return self._written_out(rows).groupBy("source").agg(F.max("dist").cast("int").alias("lsp"))


def _new_bits(cand: DataFrame, layers: list[DataFrame]) -> DataFrame:
    """Candidates without the bits that a layer has. Candidates and layers are
    partitioned alike, so their union is grouped where it lies."""
    none = F.lit(0).cast("long")
    both = cand.select("word", "vertex", "bits", none.alias("seen"))
    for layer in layers:
        both = both.union(layer.select("word", "vertex", none, "bits"))
    left = F.bit_or("bits").bitwiseAND(F.bitwise_not(F.bit_or("seen")))
    return both.groupBy("word", "vertex").agg(left.alias("bits")).where("bits != 0")


def _merged_bits(rows: DataFrame) -> DataFrame:
    return rows.groupBy("word", "vertex").agg(F.bit_or("bits").alias("bits"))


def _own_bits(numbered: DataFrame, partitions: int) -> DataFrame:
    """(s_vertex, s_word, s_bits) of the sources, dealt as the edges are, so that
    a round moves its frontier alone."""
    own = numbered.select(F.col("source").alias("s_vertex"), F.col("word").alias("s_word"), _bit("bit").alias("s_bits"))
    return materialize(own.repartition(partitions, "s_vertex").sortWithinPartitions("s_vertex"))[0]


def _allowed(frontier: DataFrame, own: DataFrame, graph: HopGraph, ss: SourceSet) -> DataFrame:
    """The frontier without the bits that a source of another traversal holds up."""
    own = _side(graph.spark, own, ss.count, row_bytes(1, ss.max_len, fixed_cols=2))
    met = frontier.join(own, F.col("vertex") == F.col("s_vertex"), "left")
    mine = F.when(F.col("s_vertex").isNull(), F.col("bits")).when(F.col("word") == F.col("s_word"), F.col("bits").bitwiseAND(F.col("s_bits"))).otherwise(F.lit(0).cast("long"))
    return met.select("word", "vertex", mine.alias("bits")).where("bits != 0")


def _spread(graph: HopGraph, frontier: DataFrame, rows: int) -> DataFrame:
    """(word, vertex, bits) at the out-neighbours, one row for each edge."""
    salts = 1
    f = frontier
    if graph.hot is not None:
        f = f.join(F.broadcast(graph.hot), F.col("vertex") == F.col("hot_vertex"), "left").select(
            "word", "vertex", "bits", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("nsalt"), F.lit(1)) - 1)).alias("salt")
        )
        salts = -(-graph.max_out_degree // graph.chunk)
    f = _side(graph.spark, f, rows * salts, row_bytes(1, graph.max_id_length, fixed_cols=3)).alias("f")
    on = F.col("f.vertex") == F.col("e.src")
    if graph.hot is not None:
        on = on & (F.col("f.salt") == F.col("e.salt"))
    return f.join(graph.aliased_edges(), on).select(F.col("f.word"), F.col("e.dst").alias("vertex"), F.col("f.bits"))


def bit_paths(graph: HopGraph, sources, *, max_rounds: int | None = None, stop_at_other_sources: bool = False,
              seed_sinks: bool = False, compact_every: int = DEFAULT_COMPACT_EVERY) -> BitTraversal:
    """Hop distances as :func:`~hopscope.operators.traversal.shortest_paths`
    gives them, for any number of sources, worked out on bit words."""
    spark = graph.spark
    ss = source_set(spark, sources)
    numbered = _numbered(graph, ss)
    words = max(1, math.ceil(ss.count / WORD_BITS))
    p = graph.first_partitions(words)
    kept = numbered
    if not seed_sinks:
        small = fits_broadcast(spark, ss.count, row_bytes(1, ss.max_len))
        keys = _edges_near(graph, numbered, "source", small, "out").select(F.col("src").alias("key"))
        if small:
            keys = keys.join(F.broadcast(numbered.select(F.col("source").alias("s"))), F.col("key") == F.col("s"), "left_semi")
        kept = numbered.join(keys.distinct(), F.col("source") == F.col("key"), "left_semi")
    metrics = lambda name: [F.sum(F.bit_count(name("bits"))).alias("pairs")]
    stats: list[tuple[int, int]] = []
    converged = False
    with scoped_conf(spark, iteration_settings(p)):
        start = kept.select("word", F.col("source").alias("vertex"), _bit("bit").alias("bits"))
        start = _merged_bits(start.repartition(p, "word", "vertex"))
        frontier, rows = materialize(start)
        own = _own_bits(numbered, graph.partitions) if stop_at_other_sources else None
        rounds, layers = [(frontier, 0)], [(frontier, rows)]
        rnd = 0
        while max_rounds is None or rnd < max_rounds:
            rnd += 1
            if rows == 0:
                stats.append((rnd, 0))
                converged = True
                break
            ahead = graph.partitions_ahead(p, sum(n for _, n in layers), frontier, rows, words)
            if ahead > p:
                p = ahead
                spark.conf.set("spark.sql.shuffle.partitions", str(p))
                merged = functools.reduce(DataFrame.union, [df for df, _ in layers])
                layers = [materialize(_merged_bits(merged.repartition(p, "word", "vertex")))]
            f = _allowed(frontier, own, graph, ss) if stop_at_other_sources else frontier
            new = _new_bits(_merged_bits(_spread(graph, f, rows)), [df for df, _ in layers])
            new, rows, told = materialize_observed(new, metrics)
            pairs = int(told["pairs"] or 0)
            stats.append((rnd, pairs))
            log_round(rnd, pairs)
            if rows == 0:
                converged = True
                break
            rounds.append((new, rnd))
            layers.append((new, rows))
            frontier = new
            at = tail_to_merge([n for _, n in layers], compact_every)
            if at < len(layers):
                merged = _merged_bits(functools.reduce(DataFrame.union, [df for df, _ in layers[at:]]))
                layers[at:] = [materialize(merged)]
    return BitTraversal(graph, ss, numbered, rounds, stats, converged)
