"""Hop-distance traversals on a prepared graph.

Two evaluation modes share one round loop:

``bfs``   fresh traversal. With unit weights the first arrival at a vertex is
          its minimum, so a candidate is new exactly when no earlier layer
          holds its ``(source, vertex)``. Only the vertices reached in the last
          round (the frontier) are expanded.
``relax`` warm start from arbitrary stored distances (semi-naive
          Bellman-Ford). Every stored finite row is active in the first
          round; afterwards only rows that improved are expanded, and a
          candidate survives only if no layer holds a distance <= its own.

State is a list of *layers*, each one a checkpointed frame hash-partitioned
on ``(source, vertex)`` and sorted within partitions. A round:

1. frontier rows of hot vertices are replicated once per salt;
2. the frontier joins the cached edges on ``(vertex, salt)``: broadcast when
   its counted size fits the broadcast limit, otherwise shuffled to the edge
   partitioning (the edges are never shuffled); vertices that many sources
   reach at once, so that frontier rows times out-edges exceed ``WORK_CHUNK``,
   are joined apart, their frontier rows split by source and their edges by
   target, both copied as often as the other is split;
3. candidates are reduced per ``(source, vertex)`` (partial aggregation before
   the shuffle, so a vertex with a huge in-degree costs one row per task);
4. candidates merge-anti-join each layer in turn: layers share the
   candidates' partitioning and ordering, so visited state is streamed, never
   reshuffled or re-sorted;
5. the survivors are checkpointed to reliable storage and counted; an empty
   round ends the loop.

Once more than ``compact_every`` layers have gathered, the newest are merged, as
far back as those of at most twice their rows: the plan stays small on deep
graphs, and a row is rewritten only as often as its layer grows by half.

A traversal from a list of sources may go ``bottom_up`` on dense rounds
(:mod:`hopscope.operators.bottom_up`).

A graph that lies in an edge store (:mod:`hopscope.plans.edge_store`) is read
bucket by bucket while a frontier is small, and a traversal with a ``log``
(:mod:`hopscope.plans.generations`) keeps each round where a later session can
take it up.
"""

from __future__ import annotations

import functools
import logging
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hopscope.functions.expressions import next_hop
from hopscope.operators.bottom_up import BottomUp
from hopscope.plans.edge_store import bitmap_columns, bucket_of, buckets_in
from hopscope.plans.generations import GenerationLog, open_generation, tail_to_merge
from hopscope.plans.graph import HopGraph, prepare_graph
from hopscope.plans.session import (
    fits_broadcast,
    iteration_settings,
    materialize,
    materialize_observed,
    row_bytes,
    scoped_conf,
)

DEFAULT_COMPACT_EVERY = 8
#: Candidates of one vertex, frontier rows times out-edges, that one task makes.
WORK_CHUNK = 4_000_000

logger = logging.getLogger("hopscope")


# --------------------------------------------------------------------------
# sources
# --------------------------------------------------------------------------
@dataclass
class SourceSet:
    frame: DataFrame          # one column: source string
    count: int
    max_len: int
    values: list[str] | None  # the ids when given as a list
    blocked: DataFrame | None = None  # one column: blocked, the ids in the layout's type, computed once


def source_set(spark: SparkSession, sources) -> SourceSet:
    """Sources as a list of ids (duplicates collapse to one traversal) or a
    frame with a ``source`` column."""
    if isinstance(sources, DataFrame):
        col = "source" if "source" in sources.columns else sources.columns[0]
        frame = sources.select(F.col(col).cast("string").alias("source")).where(F.col("source").isNotNull()).distinct()
        row = frame.agg(F.count(F.lit(1)).alias("n"), F.max(F.length("source")).alias("l")).first()
        return SourceSet(frame, int(row["n"]), int(row["l"] or 1), None)
    if isinstance(sources, (str, int)):
        sources = [sources]
    values = list(dict.fromkeys(str(s) for s in sources))
    frame = spark.createDataFrame([(v,) for v in values], "source string")
    return SourceSet(frame, len(values), max((len(v) for v in values), default=1), values)


def _side(spark: SparkSession, df: DataFrame, rows: int, bytes_per_row: int) -> DataFrame:
    """Broadcast a join side whose row count and row width are known bounds;
    otherwise ask for a sort-merge join so nothing large is broadcast."""
    if fits_broadcast(spark, rows, bytes_per_row):
        return F.broadcast(df)
    return df.hint("merge")


def _internal_sources(graph: HopGraph, ss: SourceSet) -> DataFrame:
    """The sources as ``source`` in the graph's id type (ids that cannot be
    vertices of this graph drop out)."""
    return ss.frame.select(graph.internal_id(F.col("source")).alias("source")).where(F.col("source").isNotNull())


def _to_internal(graph: HopGraph, df: DataFrame) -> DataFrame:
    """``(source, vertex, dist)`` with user (string) ids -> layout ids."""
    return df.select(
        graph.internal_id(F.col("source")).alias("source"),
        graph.internal_id(F.col("vertex")).alias("vertex"),
        F.col("dist").cast("int").alias("dist"),
    ).where(F.col("source").isNotNull() & F.col("vertex").isNotNull())


def _outside(graph: HopGraph, df: DataFrame) -> DataFrame | None:
    """The rows (source, vertex, dist) with an id that the layout's type cannot
    hold, so that no edge has it; None if any id could be a vertex."""
    if graph.id_type == "string":
        return None
    known = graph.internal_id(F.col("source")).isNotNull() & graph.internal_id(F.col("vertex")).isNotNull()
    rows = df.select("source", "vertex", F.col("dist").cast("int").alias("dist")).where(~known & F.col("dist").isNotNull())
    return rows.where(F.col("source").isNotNull() & F.col("vertex").isNotNull()).groupBy("source", "vertex").agg(F.min("dist").alias("dist"))


def _to_public(graph: HopGraph, df: DataFrame) -> DataFrame:
    """``(source, vertex, dist)`` with layout ids -> string ids."""
    return df.select(
        graph.public_id(F.col("source")).alias("source"),
        graph.public_id(F.col("vertex")).alias("vertex"),
        F.col("dist").cast("int").alias("dist"),
    )


def _edges_near(graph: HopGraph, vertices: DataFrame, column: str, small: bool, side: str) -> DataFrame:
    """The edges whose ``src`` (side out) or ``dst`` (side in) may be one of some
    vertices: of a stored graph their buckets alone, if they are few."""
    if graph.store is not None and (small or side == "in"):
        touched = graph.store.touched(vertices, column) if small else None
        if side == "in" or 2 * len(touched) <= graph.store.buckets:
            return graph.store.scan(side, touched).select("src", "dst")
    return graph.edges


def _seeds_at_sources(graph: HopGraph, ss: SourceSet, seed_sinks: bool) -> DataFrame:
    s = _internal_sources(graph, ss)
    if not seed_sinks:
        spark = graph.spark
        if fits_broadcast(spark, ss.count, row_bytes(1, ss.max_len)):
            e = _edges_near(graph, s, "source", True, "out")
            s = (
                e.join(F.broadcast(s), e.src == s.source, "left_semi")
                .select(F.col("src").alias("source"))
                .distinct()
            )
        else:
            keys = graph.edges.select(F.col("src").alias("key")).distinct()
            s = s.join(keys, s.source == keys.key, "left_semi")
    return s.select("source", F.col("source").alias("vertex"), F.lit(0).cast("int").alias("dist"))


def _seeds_at_in_neighbors(graph: HopGraph, ss: SourceSet) -> DataFrame:
    s = _internal_sources(graph, ss)
    small = fits_broadcast(graph.spark, ss.count, row_bytes(1, ss.max_len))
    e = _edges_near(graph, s, "source", small, "in")
    s = _side(graph.spark, s, ss.count, row_bytes(1, ss.max_len))
    return e.join(s, e.dst == F.col("source")).select(
        F.col("source"), F.col("src").alias("vertex"), F.lit(1).cast("int").alias("dist")
    )


def seed_from_sources(graph: HopGraph, sources, seed_sinks: bool = False) -> DataFrame:
    """``(source, vertex, dist)`` with each source at distance 0.

    By default a source is seeded only if it has an out-edge; an unknown or
    sink-only source gives an empty traversal. ``seed_sinks=True`` seeds every
    listed source.
    """
    ss = sources if isinstance(sources, SourceSet) else source_set(graph.spark, sources)
    seeds = _to_public(graph, _seeds_at_sources(graph, ss, seed_sinks))
    outside = _outside(graph, _at_themselves(ss)) if seed_sinks else None
    return seeds if outside is None else seeds.unionByName(outside)


def _at_themselves(ss: SourceSet) -> DataFrame:
    return ss.frame.select("source", F.col("source").alias("vertex"), F.lit(0).alias("dist"))


def seed_from_in_neighbors(graph: HopGraph, sources) -> DataFrame:
    """``(source, vertex, dist=1)`` for every in-neighbour of each source:
    the vertices whose adjacency list contains the source."""
    ss = sources if isinstance(sources, SourceSet) else source_set(graph.spark, sources)
    return _to_public(graph, _seeds_at_in_neighbors(graph, ss))


# --------------------------------------------------------------------------
# one expansion step
# --------------------------------------------------------------------------
def heavy_vertices(graph: HopGraph, frontier: DataFrame, frontier_rows: int, sources: int) -> tuple[DataFrame, int] | None:
    """(h_vertex, parts, salts) of the frontier's vertices that make more than
    ``WORK_CHUNK`` candidates each, and how many these are; None if there are
    none. There are at most candidates / WORK_CHUNK of them."""
    most = min(frontier_rows, sources)
    if most * graph.max_out_degree <= WORK_CHUNK:
        return None
    large = graph.large_degrees(WORK_CHUNK // most)
    work = frontier.join(large, F.col("vertex") == F.col("d_vertex")).groupBy("d_vertex", "deg").agg(F.count("*").alias("n"))
    salts = F.ceil(F.col("deg") / graph.chunk)
    parts = F.ceil(F.col("n") * F.ceil(F.col("deg") / salts) / WORK_CHUNK)
    heavy = work.where(F.col("n") * F.col("deg") > WORK_CHUNK)
    found, n = materialize(heavy.select(F.col("d_vertex").alias("h_vertex"), parts.cast("int").alias("parts"), salts.cast("int").alias("salts")))
    return (found, n) if n else None


def _expand_heavy(graph: HopGraph, f: DataFrame, heavy: DataFrame) -> DataFrame:
    """Candidates of heavy vertices, in parts of about ``WORK_CHUNK``."""
    mine = f.join(heavy, F.col("vertex") == F.col("h_vertex")).select(
        "source", "vertex", "dist", F.pmod(F.xxhash64("source"), F.col("parts")).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("cell"),
    )
    e = graph.edges.select(F.col("src").alias("e_src"), F.col("dst").alias("e_dst"))
    theirs = e.join(heavy, F.col("e_src") == F.col("h_vertex")).select(
        "e_src", "e_dst", F.pmod(F.xxhash64("e_dst"), F.col("salts")).cast("int").alias("e_cell"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("e_part"),
    )
    on = (F.col("vertex") == F.col("e_src")) & (F.col("part") == F.col("e_part")) & (F.col("cell") == F.col("e_cell"))
    return mine.join(theirs.hint("merge"), on).select("source", F.col("e_dst").alias("vertex"), next_hop(F.col("dist")).alias("dist"))


def _unblocked(graph: HopGraph, f: DataFrame, blocked: SourceSet | None) -> DataFrame:
    """The frontier rows that expand: not those of other traversals' sources."""
    if blocked is None:
        return f
    if blocked.values is not None:
        return f.where(~F.col("vertex").isin(graph.internal_values(blocked.values)) | (F.col("vertex") == F.col("source")))
    b = blocked.blocked
    if b is None:
        b = _internal_sources(graph, blocked).select(F.col("source").alias("blocked"))
    b = _side(graph.spark, b, blocked.count, row_bytes(1, blocked.max_len))
    return f.join(b, (F.col("vertex") == F.col("blocked")) & (F.col("source") != F.col("blocked")), "left_anti")


def expand(graph: HopGraph, frontier: DataFrame, frontier_rows: int | None = None,
           blocked: SourceSet | None = None, clean: bool = False, buckets: list[int] | None = None, sources: int | None = None) -> DataFrame:
    """Candidates ``(source, vertex, dist + 1)`` along every out-edge of the
    frontier, one row per edge (not yet reduced). Ids are in the graph's
    layout type.

    ``blocked``: vertices that do not expand in any traversal but their own
    (a source is absorbing in the other sources' traversals).
    ``frontier_rows``: a counted bound on the frontier, used to decide
    whether broadcasting it is safe; ``None`` leaves the choice to Spark.
    ``clean``: the frontier is a layer of the round loop (exactly
    ``source, vertex, dist``, no NULL distance), so it is used as it is.
    ``buckets``: the edge store's buckets that hold the frontier's edges; if
    they are few and the frontier is small, only they are read.
    ``sources``: how many traversals there are, if vertices that many of them
    have reached are to be split.
    """
    spark = graph.spark
    f = frontier if clean else frontier.select("source", "vertex", "dist").where(F.col("dist").isNotNull())
    f = _unblocked(graph, f, blocked)

    width = row_bytes(2, max(graph.max_id_length, blocked.max_len if blocked else 1), fixed_cols=3)
    if buckets is not None and 2 * len(buckets) <= graph.store.buckets and fits_broadcast(spark, frontier_rows, width):
        f = f.select("source", "vertex", "dist", bucket_of("vertex", graph.store.buckets).alias("f_bucket"))
        e = graph.store.scan("out", buckets).select("bucket", "src", F.col("dst").alias("e_dst"))
        near = e.join(F.broadcast(f), (F.col("bucket") == F.col("f_bucket")) & (F.col("src") == F.col("vertex")))
        return near.select("source", F.col("e_dst").alias("vertex"), next_hop(F.col("dist")).alias("dist"))

    apart = heavy_vertices(graph, f, frontier_rows, sources) if sources is not None else None
    if apart is not None:
        heavy = _side(spark, apart[0], apart[1], row_bytes(1, graph.max_id_length, fixed_cols=2))
        light = f.join(heavy, F.col("vertex") == F.col("h_vertex"), "left_anti")
        return _expand_heavy(graph, f, heavy).union(expand(graph, light, frontier_rows, clean=True))

    max_salts = 1
    if graph.hot is not None:
        h = F.broadcast(graph.hot)
        f = f.join(h, F.col("vertex") == F.col("hot_vertex"), "left").select(
            "source", "vertex", "dist",
            F.explode(F.sequence(F.lit(0), F.coalesce(F.col("nsalt"), F.lit(1)) - 1)).alias("salt"),
        )
        max_salts = -(-graph.max_out_degree // graph.chunk)

    if frontier_rows is not None:
        width = row_bytes(2, max(graph.max_id_length, blocked.max_len if blocked else 1), fixed_cols=2)
        f = _side(spark, f, frontier_rows * max_salts, width)
    f = f.alias("f")
    e = graph.aliased_edges()
    on = F.col("f.vertex") == F.col("e.src")
    if graph.hot is not None:
        on = on & (F.col("f.salt") == F.col("e.salt"))
    # ``source`` passes through under its own name and attribute: re-aliasing
    # it would make a checkpoint of this plan record a partitioning on an
    # attribute it does not output, and the next round would reshuffle.
    return f.join(e, on).select(
        F.col("f.source"),
        F.col("e.dst").alias("vertex"),
        next_hop(F.col("f.dist")).alias("dist"),
    )


def reduce_candidates(cand: DataFrame) -> DataFrame:
    return cand.groupBy("source", "vertex").agg(F.min("dist").cast("int").alias("dist"))


# --------------------------------------------------------------------------
# the round loop
# --------------------------------------------------------------------------
@dataclass
class Traversal:
    """Result of a traversal.

    ``distances``: ``(source, vertex, dist)`` for every reached vertex.
    ``stats``: ``(round, updated)`` per round run; the last entry has 0 updates
    when the traversal reached its fixpoint.
    """

    graph: HopGraph
    sources: SourceSet | None
    layers: list[DataFrame]
    stats: list[tuple[int, int]]
    converged: bool
    mode: str
    absorbing: bool = False
    rows_rewritten: int = 0  # by merging layers
    outside: DataFrame | None = None  # rows with ids that no edge can have
    directions: list[tuple[int, str, int]] = field(default_factory=list)  # (round, down or up, candidates) with bottom_up
    _distances: DataFrame | None = field(default=None, repr=False)

    @property
    def rounds(self) -> int:
        return len(self.stats)

    @property
    def distances(self) -> DataFrame:
        if self._distances is None:
            merged = functools.reduce(DataFrame.union, self.layers)
            if self.mode == "relax":
                merged = reduce_candidates(merged)
            self._distances = _to_public(self.graph, merged)
            if self.outside is not None:
                self._distances = self._distances.unionByName(self.outside)
        return self._distances

    def stats_frame(self) -> DataFrame:
        """``(round int, updated long)``; one row per round run."""
        return self.graph.spark.createDataFrame(self.stats, "round int, updated long")

    def with_unreached(self, vertex_set: str = "keys_and_reached") -> DataFrame:
        """Distances plus a NULL-distance row for each unreached vertex.

        ``keys_and_reached``: every vertex with out-edges, per source (the
        fixpoint jobs' output set); ``all``: every vertex of the graph (the
        bounded jobs' output set). With absorbing sources, a source gets no
        row in another source's traversal unless it was reached there.
        The output has one row per (source, vertex), so sources must be a
        list of ids.
        """
        if vertex_set not in ("reached", "keys_and_reached", "all"):
            raise ValueError(f"unknown vertex_set {vertex_set!r}")
        if vertex_set == "reached":
            return self.distances
        if self.sources is None or self.sources.values is None:
            raise ValueError("with_unreached needs the sources as a list of ids")
        base = self.graph.keys() if vertex_set == "keys_and_reached" else self.graph.vertices()
        srcs = F.array(*[F.lit(v) for v in self.sources.values])
        rows = base.select(F.explode(srcs).alias("source"), "vertex")
        if self.absorbing:
            rows = rows.where(~F.col("vertex").isin(self.sources.values) | (F.col("vertex") == F.col("source")))
        missing = rows.join(self.distances, ["source", "vertex"], "left_anti").select(
            "source", "vertex", F.lit(None).cast("int").alias("dist")
        )
        return self.distances.unionByName(missing)


def _probe_view(layer: DataFrame) -> DataFrame:
    """A layer as the right side of the visited check: renamed columns (every
    layer carries the same ``source`` attribute as the candidates; two join
    sides sharing an attribute make Spark re-instance one side and forget its
    partitioning) and a merge-join hint (layers are co-partitioned and sorted,
    so they must never be broadcast or reshuffled)."""
    return layer.select(
        F.col("source").alias("l_source"), F.col("vertex").alias("l_vertex"), F.col("dist").alias("l_dist")
    ).hint("merge")


def _layer_anti_join(cand: DataFrame, probes: list[DataFrame]) -> DataFrame:
    """Drop candidates that some layer already holds at a distance <= theirs.
    Each anti-join is a merge within the stage: no shuffle, no sort, no
    extra job."""
    out = cand
    for lay in probes:
        out = out.join(
            lay,
            (out["source"] == lay["l_source"]) & (out["vertex"] == lay["l_vertex"]) & (lay["l_dist"] <= out["dist"]),
            "left_anti",
        )
    return out


def _laid_out(graph: HopGraph, ss: SourceSet) -> SourceSet:
    """Blocked sources given as a frame, computed once and dealt as the edges
    are, so that a round moves its frontier alone."""
    ids = _internal_sources(graph, ss).select(F.col("source").alias("blocked"))
    ids, _ = materialize(ids.repartition(graph.partitions, "blocked").sortWithinPartitions("blocked"))
    return replace(ss, blocked=ids)


def _compact(layers: list[tuple[DataFrame, int]], mode: str, partitions: int | None = None) -> tuple[DataFrame, int]:
    """The layers as one; dealt anew if ``partitions`` are given."""
    merged = functools.reduce(DataFrame.union, [df for df, _ in layers])
    if partitions is not None:
        merged = merged.repartition(partitions, "source", "vertex")
    if mode == "relax":
        merged = reduce_candidates(merged)
    return materialize(merged.sortWithinPartitions("source", "vertex"))


def iterate(graph: HopGraph, initial: DataFrame, *, mode: str = "bfs", max_rounds: int | None = None,
            blocked: SourceSet | None = None, sources: SourceSet | None = None,
            compact_every: int = DEFAULT_COMPACT_EVERY, log: GenerationLog | None = None,
            past: list[tuple[int, int]] | None = None, front_dist: int | None = None,
            done: bool = False, bottom_up: bool = False) -> Traversal:
    """Run rounds from ``initial`` ``(source, vertex, dist)`` rows (ids in the
    graph's layout type) until a round changes nothing or ``max_rounds`` ran.

    All rows are active in the first round; with ``front_dist`` only those at
    that distance are, the others being visited before. ``past``: the rounds
    that led there, ``done`` if they led to the fixpoint. ``log``: commit each
    round to it. ``bottom_up``: dense rounds start from the unreached vertices;
    all rows of ``initial`` must then be at one distance.
    """
    if mode not in ("bfs", "relax"):
        raise ValueError(f"unknown mode {mode!r}")
    if bottom_up and (mode != "bfs" or past or sources is None or sources.values is None):
        raise ValueError("bottom_up needs a fresh traversal from a list of sources")
    spark = graph.spark
    n_sources = sources.count if sources is not None else 1
    # Bottom-up rounds hold the unreached pairs too: room for all pairs.
    p = graph.state_partitions(n_sources) if bottom_up else graph.first_partitions(n_sources)
    stats: list[tuple[int, int]] = list(past or [])
    converged = done
    rewritten = 0
    store = graph.store
    metrics = None if store is None else lambda name: bitmap_columns(name("vertex"), store.buckets)

    def touched(seen: dict) -> list[int] | None:
        return None if store is None else buckets_in([seen[f"b{w}"] for w in range(len(seen) - 1)])

    def commit(reached: DataFrame | None, rows: int, distance: int | None) -> None:
        if log is not None:
            told = {} if distance is None else {"front_dist": distance}
            log.append(None if reached is None else _to_public(graph, reached), rows, stats, converged=converged, **told)

    with scoped_conf(spark, iteration_settings(p)):
        start = initial.select("source", "vertex", F.col("dist").cast("int").alias("dist")).where(
            F.col("dist").isNotNull()
        )
        start = reduce_candidates(start.repartition(p, "source", "vertex")).sortWithinPartitions("source", "vertex")
        layer0, n0, seen = materialize_observed(start, metrics)
        if blocked is not None and blocked.values is None:
            blocked = _laid_out(graph, blocked)
        layers: list[tuple[DataFrame, int]] = [(layer0, n0)]
        probes = [_probe_view(layer0)]
        frontier, n_front, near = layer0, n0, touched(seen)
        if front_dist is not None:
            frontier, n_front, seen = materialize_observed(layer0.where(F.col("dist") == front_dist).sortWithinPartitions("source", "vertex"), metrics)
            near = touched(seen)
        elif log is not None:
            front_dist = layer0.agg(F.max("dist")).first()[0] if mode == "bfs" else None
            commit(layer0, n0, front_dist)
        look = BottomUp(graph, layer0, n0, p) if bottom_up else None
        rnd = len(stats)
        while not done and (max_rounds is None or rnd < max_rounds):
            rnd += 1
            if n_front == 0:
                stats.append((rnd, 0))
                converged = True
                break
            counted = None
            held = sum(rows for _, rows in layers)
            ahead = p if look is not None else graph.partitions_ahead(p, held, frontier, n_front, n_sources)
            if ahead > p:
                p = ahead
                spark.conf.set("spark.sql.shuffle.partitions", str(p))
                rewritten += held
                layers = [_compact(layers, mode, p)]
                probes = [_probe_view(layers[0][0])]
            if look is not None and look.pays():
                new, counted = look.step(_unblocked(graph, frontier, blocked), n_front)
            else:
                cand = reduce_candidates(expand(graph, frontier, n_front, blocked, clean=True, buckets=near, sources=n_sources))
                new = _layer_anti_join(cand, probes)
            new, n, seen = materialize_observed(new.sortWithinPartitions("source", "vertex"), metrics)
            stats.append((rnd, n))
            if look is not None:
                look.rounds.append((rnd, "down", look.leaving) if counted is None else (rnd, "up", sum(int(c.get["n"]) for c in counted)))
                look.reached(new, n)
            log_round(rnd, n)
            if n == 0:
                converged = True
                break
            front_dist = None if front_dist is None else front_dist + 1
            commit(new, n, front_dist)
            layers.append((new, n))
            probes.append(_probe_view(new))
            frontier, n_front, near = new, n, touched(seen)
            at = tail_to_merge([rows for _, rows in layers], compact_every)
            if at < len(layers):
                rewritten += sum(rows for _, rows in layers[at:])
                layers[at:] = [_compact(layers[at:], mode)]
                probes[at:] = [_probe_view(layers[at][0])]
        if converged and not done:
            commit(None, 0, None)
    return Traversal(
        graph=graph,
        sources=sources,
        layers=[df for df, _ in layers],
        stats=stats,
        converged=converged,
        mode=mode,
        absorbing=blocked is not None,
        rows_rewritten=rewritten,
        directions=look.rounds if look is not None else [],
    )


def log_round(rnd: int, updated: int) -> None:
    logger.info("round %d: %d updated", rnd, updated)


# --------------------------------------------------------------------------
# user-facing traversals
# --------------------------------------------------------------------------
def shortest_paths(graph: HopGraph, sources, *, max_rounds: int | None = None,
                   stop_at_other_sources: bool = False, seed_sinks: bool = False,
                   compact_every: int = DEFAULT_COMPACT_EVERY, log: str | None = None,
                   bottom_up: bool = False) -> Traversal:
    """Hop distance from every source to every vertex it reaches, along
    out-edges, run to the fixpoint (or ``max_rounds`` rounds).

    Any number of sources share each round. ``stop_at_other_sources=True``
    makes every source absorbing in the other sources' traversals: it is
    reached with its true distance, but nothing is reached through it.
    ``log``: a folder in which each round is kept (:func:`continue_paths`).
    ``bottom_up``: on rounds where, by count, more edges leave the frontier than
    enter unreached vertices, these look for a parent instead (for sources given
    as a list; ``directions`` of the result tells the rounds).
    """
    ss = source_set(graph.spark, sources)
    seeds = _seeds_at_sources(graph, ss, seed_sinks)
    t = iterate(graph, seeds, mode="bfs", max_rounds=max_rounds,
                blocked=ss if stop_at_other_sources else None, sources=ss,
                compact_every=compact_every, log=_new_log(graph, log, ss, "bfs", stop_at_other_sources),
                bottom_up=bottom_up)
    t.outside = _outside(graph, _at_themselves(ss)) if seed_sinks else None
    return t


def _new_log(graph: HopGraph, path: str | None, ss: SourceSet, mode: str, absorbing: bool) -> GenerationLog | None:
    if path is None:
        return None
    made = GenerationLog(graph.spark, path)
    made.begin(ss.frame, ss.values, mode=mode, absorbing=absorbing)
    return made


def continue_paths(graph: HopGraph, log: str, *, max_rounds: int | None = None,
                   compact_every: int = DEFAULT_COMPACT_EVERY) -> Traversal:
    """Take a traversal up from the last whole generation of its log and go on
    logging. Only the rows of the last round are expanded first, so the rounds
    and their updates are those of a traversal that never stopped.
    ``max_rounds`` counts from the traversal's start."""
    kept = open_generation(graph.spark, log)
    ss = source_set(graph.spark, kept.sources())
    record = kept.record
    return iterate(graph, _to_internal(graph, kept.state()), mode=record["mode"],
                   max_rounds=max_rounds,
                   blocked=ss if record["absorbing"] else None, sources=ss, compact_every=compact_every,
                   log=GenerationLog(graph.spark, log), past=kept.stats, front_dist=record.get("front_dist"),
                   done=kept.converged)


def bounded_relaxation(graph: HopGraph, sources, rounds: int | None = None,
                       compact_every: int = DEFAULT_COMPACT_EVERY, log: str | None = None,
                       bottom_up: bool = False) -> Traversal:
    """Relaxation seeded at the in-neighbours of each source (distance 1),
    run along out-edges to the fixpoint, or for at most ``rounds`` rounds
    (``converged`` of the result says whether that cut anything off).

    The source itself starts unreached; it ends at 2 if it has an
    in-neighbour (1 with a self-loop). After ``rounds`` rounds the largest
    finite distance is at most ``rounds + 1``. Stopping early when a round
    changes nothing gives the same rows as running all rounds. ``bottom_up``
    as in :func:`shortest_paths`.
    """
    ss = source_set(graph.spark, sources)
    seeds = _seeds_at_in_neighbors(graph, ss)
    return iterate(graph, seeds, mode="bfs", max_rounds=rounds, sources=ss, compact_every=compact_every,
                   log=_new_log(graph, log, ss, "bfs", False), bottom_up=bottom_up)


def resume_shortest_paths(graph: HopGraph, state: DataFrame, *, sources=None,
                          stop_at_other_sources: bool = False, max_rounds: int | None = None,
                          compact_every: int = DEFAULT_COMPACT_EVERY) -> Traversal:
    """Continue a traversal from stored ``(source, vertex, dist)`` rows.

    Every finite stored row is active in the first round (stored distances
    need not come from a clean breadth-first run), then only improved rows
    expand. The result equals an uninterrupted run whenever the stored
    distances are upper bounds reached from the sources. Rows whose ids
    cannot be vertices of the graph (e.g. "007" in a numeric graph) stay as
    they are; rows of sources that ``sources`` does not name are ignored.
    """
    spark = graph.spark
    if sources is None:
        ss = source_set(spark, state.where(F.col("dist").isNotNull()).select("source"))
    else:
        ss = source_set(spark, sources)
        wanted = F.col("source").isin(ss.values) if ss.values is not None else None
        state = state.where(wanted) if wanted is not None else state.join(ss.frame, "source", "left_semi")
    # The finite rows are read several times: what made them (text, say) runs once.
    state, _ = materialize(state.select("source", "vertex", F.col("dist").cast("int").alias("dist")).where(F.col("dist").isNotNull()))
    outside = _outside(graph, state)
    if outside is not None and not outside.where(graph.internal_id(F.col("vertex")).isNotNull()).isEmpty():
        # A source that the layout's type cannot hold has reached vertices: go on with ids as strings.
        graph, outside = prepare_graph(graph.edge_pairs(), graph.partitions, numeric_ids=False), None
    t = iterate(graph, _to_internal(graph, state), mode="relax", max_rounds=max_rounds,
                blocked=ss if stop_at_other_sources else None, sources=ss,
                compact_every=compact_every)
    t.outside = outside
    return t


def relax_round(graph: HopGraph, state: DataFrame) -> DataFrame:
    """One full relaxation step: every finite row keeps its distance and
    offers ``dist + 1`` to each out-neighbour; the minimum per
    ``(source, vertex)`` wins."""
    s = _to_internal(graph, state).where(F.col("dist").isNotNull())
    return _to_public(graph, reduce_candidates(s.unionByName(expand(graph, s))))


def updated_count(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row ``updated``: how many ``(source, vertex)`` rows of ``after``
    are new or strictly shorter than in ``before``."""
    b = before.where(F.col("dist").isNotNull()).select(
        "source", "vertex", F.col("dist").alias("before_dist")
    )
    a = after.where(F.col("dist").isNotNull())
    joined = a.join(b, ["source", "vertex"], "left")
    return joined.agg(
        F.count_if(F.col("before_dist").isNull() | (F.col("dist") < F.col("before_dist"))).alias("updated")
    )
