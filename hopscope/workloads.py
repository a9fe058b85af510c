"""Named workloads on the driver tables, each with an equivalent SQL text.

Every workload reads ``lineitem`` or ``orders`` (and ``part`` for the id
range) from ``sf_dir`` and derives its graph there, from all rows, so its work
grows with the tables. The SQL texts run on DuckDB over the same tables and
serve as the independent check of each result: same column names, same rows.

Graphs (see :mod:`hopscope.sources.tables`): ``part_next`` (dense, one
large component) and ``order_next`` (sparse: sinks, unreachable vertices,
paths of 20+ hops).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hopscope.operators.adjacency import adjacency_text, to_adjacency, to_edges
from hopscope.operators.bitsets import bit_paths
from hopscope.operators.sampling import draw_ids, sample_ids
from hopscope.operators.subgraph import induced_subgraph
from hopscope.operators.summary import diameter_lower_bound, longest_shortest_path
from hopscope.operators.traversal import (
    bounded_relaxation,
    continue_paths,
    relax_round,
    resume_shortest_paths,
    seed_from_in_neighbors,
    seed_from_sources,
    shortest_paths,
    updated_count,
)
from hopscope.plans.edge_store import open_graph, write_edge_store
from hopscope.plans.files import fresh_folder
from hopscope.plans.generations import open_generation, stored_longest_paths
from hopscope.plans.graph import prepare_graph
from hopscope.sources.line_writer import write_adjacency_lines
from hopscope.sources.sinks import adjacency_lines, distance_lines, state_lines, summary_lines
from hopscope.sources.tables import order_next, part_count, part_next, urgent_orders
from hopscope.sources.text import parse_adjacency_lines, parse_edge_lines, parse_state_lines

# ---------------------------------------------------------------------------
# Fixed parameters of the workloads. The sparse-graph ids are orders of the
# customer with most orders at sf0.01 (25 of them): its first, its thirteenth
# and its second. There they tell the traversal readings apart: the
# thirteenth cuts the first one's traversal short if sources absorb, and the
# 20-round cut changes the reach of the second. 5842 is the customer's last
# order, which has no out-edge.
# ---------------------------------------------------------------------------
SPARSE_SOURCES = ("8796", "9760")
SEED_SOURCES = ("8796", "9760", "5842", "no-such-vertex")
BOUNDED_SOURCE = "7446"
BOUNDED_ROUNDS = 20
DENSE_SOURCES = ("0", "1")
MANY_SOURCES = tuple(str(i) for i in range(16))
SAMPLE_SEED = 0
TOP_SAMPLED_SOURCES = 2
RESUME_AFTER_ROUNDS = 2
STOPPED_AFTER_ROUNDS = 3
STORE_BUCKETS = 64
#: Neighbours of an adjacency row in the workload that writes files: every part of the larger lists is short.
SHORT_LIST = 8
#: Sources of the bit-parallel workloads: the parts 0, 1, ... up to these.
BIT_SOURCES = tuple(str(i) for i in range(96))
LSP_SOURCES = tuple(str(i) for i in range(256))


# ======================================================================
# Spark side
# ======================================================================
def _sample_size(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    n = part_count(spark, sf_dir)
    return n // 4, n


def _sampled_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = _sample_size(spark, sf_dir)
    return induced_subgraph(part_next(spark, sf_dir), draw_ids(spark, k, n, seed=SAMPLE_SEED, start=0))


def q_edge_scan(spark, sf_dir):
    lines = part_next(spark, sf_dir).select(F.concat_ws(",", "src", "dst").alias("value"))
    return parse_edge_lines(lines)


def q_id_sample(spark, sf_dir):
    k, n = _sample_size(spark, sf_dir)
    return sample_ids(spark, k, n, seed=SAMPLE_SEED, start=0)


def q_induced_subgraph(spark, sf_dir):
    return _sampled_edges(spark, sf_dir)


def q_induced_by_frame(spark, sf_dir):
    """The parts of the dearer half as a plain frame of ids, without a bound."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    ids = part.where(F.col("p_retailprice") > part.agg(F.avg("p_retailprice")).first()[0]).select(F.col("p_partkey").cast("string").alias("id"))
    return induced_subgraph(part_next(spark, sf_dir), ids)


def q_sampled_adjacency(spark, sf_dir):
    return adjacency_text(to_adjacency(_sampled_edges(spark, sf_dir)))


def q_adjacency_to_edges(spark, sf_dir):
    lines = adjacency_lines(to_adjacency(_sampled_edges(spark, sf_dir)))
    return to_edges(parse_adjacency_lines(lines))


def q_seed_sources(spark, sf_dir):
    g = prepare_graph(order_next(spark, sf_dir, ids="long"))
    return seed_from_sources(g, list(SEED_SOURCES))


def q_seed_in_neighbors(spark, sf_dir):
    g = prepare_graph(order_next(spark, sf_dir, ids="long"))
    return seed_from_in_neighbors(g, [BOUNDED_SOURCE])


def q_relax_one_round(spark, sf_dir):
    g = prepare_graph(order_next(spark, sf_dir, ids="long"))
    return relax_round(g, seed_from_in_neighbors(g, [BOUNDED_SOURCE]))


def q_updated_count(spark, sf_dir):
    g = prepare_graph(order_next(spark, sf_dir, ids="long"))
    seeds = seed_from_in_neighbors(g, [BOUNDED_SOURCE])
    return updated_count(seeds, relax_round(g, seeds))


def _on_graph(edges: DataFrame, job: Callable) -> DataFrame:
    """Lay out ``edges``, run ``job`` on the graph and release the cached
    layout. Only for jobs whose result no longer reads the layout (the
    traversal distances are a union of checkpoints)."""
    g = prepare_graph(edges)
    try:
        return job(g)
    finally:
        g.unpersist()


def q_sssp(spark, sf_dir):
    return _on_graph(part_next(spark, sf_dir, ids="long"), lambda g: shortest_paths(g, [DENSE_SOURCES[0]]).distances)


def q_mssp(spark, sf_dir):
    return _on_graph(order_next(spark, sf_dir, ids="long"), lambda g: shortest_paths(g, list(SPARSE_SOURCES)).distances)


def q_mssp_dense(spark, sf_dir):
    return _on_graph(part_next(spark, sf_dir, ids="long"), lambda g: shortest_paths(g, list(DENSE_SOURCES)).distances)


def q_mssp_bottom_up(spark, sf_dir):
    """The dense traversal, its dense rounds from the unreached vertices."""
    return _on_graph(part_next(spark, sf_dir, ids="long"), lambda g: shortest_paths(g, list(DENSE_SOURCES), bottom_up=True).distances)


def q_mssp16(spark, sf_dir):
    return _on_graph(part_next(spark, sf_dir, ids="long"), lambda g: bit_paths(g, list(MANY_SOURCES)).distances)


def q_mssp_absorbing(spark, sf_dir):
    return _on_graph(
        order_next(spark, sf_dir, ids="long"),
        lambda g: shortest_paths(g, list(SPARSE_SOURCES), stop_at_other_sources=True).distances,
    )


def q_mssp_urgent(spark, sf_dir):
    """Every urgent order as a source, given as a frame, up to the customer's
    next urgent order: sources absorb."""
    return _on_graph(
        order_next(spark, sf_dir, ids="long"),
        lambda g: shortest_paths(g, urgent_orders(spark, sf_dir), stop_at_other_sources=True).distances,
    )


def q_mssp_keys_and_reached(spark, sf_dir):
    g = prepare_graph(order_next(spark, sf_dir, ids="long"))
    t = shortest_paths(g, list(SPARSE_SOURCES), stop_at_other_sources=True)
    return t.with_unreached("keys_and_reached")


def q_mssp_resume(spark, sf_dir):
    """Stop after two rounds, write the state in the text layout (infinite
    rows included), read it back and continue to the fixpoint."""
    g = prepare_graph(order_next(spark, sf_dir, ids="long"))
    partial = shortest_paths(g, list(SPARSE_SOURCES), max_rounds=RESUME_AFTER_ROUNDS)
    text = state_lines(partial.with_unreached("keys_and_reached"), to_adjacency(g.edge_pairs()))
    state = parse_state_lines(text)
    return resume_shortest_paths(g, state, sources=list(SPARSE_SOURCES)).distances


def q_bounded_relaxation(spark, sf_dir):
    return _on_graph(
        order_next(spark, sf_dir, ids="long"), lambda g: bounded_relaxation(g, [BOUNDED_SOURCE], rounds=BOUNDED_ROUNDS).distances
    )


def q_bounded_dense(spark, sf_dir):
    return _on_graph(
        part_next(spark, sf_dir, ids="long"), lambda g: bounded_relaxation(g, [DENSE_SOURCES[0]], rounds=BOUNDED_ROUNDS).distances
    )


def q_lsp_per_source(spark, sf_dir):
    return longest_shortest_path(q_mssp(spark, sf_dir))


def q_lsp_global(spark, sf_dir):
    g = prepare_graph(order_next(spark, sf_dir, ids="long"))
    t = bounded_relaxation(g, [BOUNDED_SOURCE])
    return longest_shortest_path(t.with_unreached("all"), per_source=False, unreachable_as_zero=True)


def q_round_stats(spark, sf_dir):
    return _on_graph(order_next(spark, sf_dir, ids="long"), lambda g: shortest_paths(g, list(SPARSE_SOURCES)).stats_frame())


def q_diameter_lower_bound(spark, sf_dir):
    return diameter_lower_bound(_on_graph(part_next(spark, sf_dir, ids="long"), lambda g: bit_paths(g, list(MANY_SOURCES)).longest()))


def q_sampled_diameter(spark, sf_dir):
    """The whole job: sample a quarter of the parts, keep the edges among
    them, traverse from the two sampled vertices with most out-edges, and
    report each one's longest shortest path."""
    def job(g):
        deg = g.edges.groupBy("src").agg(F.count(F.lit(1)).alias("deg")).select(g.public_id(F.col("src")).alias("source"), "deg")
        top = deg.orderBy(F.col("deg").desc(), "source").limit(TOP_SAMPLED_SOURCES)
        return longest_shortest_path(shortest_paths(g, [r["source"] for r in top.collect()]).distances)

    return _on_graph(_sampled_edges(spark, sf_dir), job)


def q_adjacency_lines(spark, sf_dir):
    """Sampled adjacency rendered as ``vertex<TAB>n1,n2,...`` lines."""
    return adjacency_lines(to_adjacency(_sampled_edges(spark, sf_dir)))


def q_state_lines(spark, sf_dir):
    """Absorbing two-source state in the text layout: ``vertex"to"source<TAB>
    list dist`` for every key and reached vertex, infinity as 2147483647."""
    g = prepare_graph(order_next(spark, sf_dir, ids="long"))
    t = shortest_paths(g, list(SPARSE_SOURCES), stop_at_other_sources=True)
    return state_lines(t.with_unreached("keys_and_reached"), to_adjacency(g.edge_pairs()), stop_at_other_sources=True)


def q_distance_tuples(spark, sf_dir):
    """Bounded relaxation over every vertex as ``(vertex,dist)`` tuples."""
    g = prepare_graph(order_next(spark, sf_dir, ids="long"))
    t = bounded_relaxation(g, [BOUNDED_SOURCE])
    return distance_lines(t.with_unreached("all"), with_source=False)


def q_edge_scan_malformed(spark, sf_dir):
    """Order lines, of which those of the lowest priority have no second end."""
    second = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(F.concat(F.lit(","), F.col("o_custkey").cast("string")))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return parse_edge_lines(orders.select(F.concat(F.col("o_orderkey").cast("string"), second).alias("value")))


def q_adjacency_file(spark, sf_dir):
    """Adjacency lists in short parts, written as one line a vertex and read back."""
    path = fresh_folder(spark, "adjacency")
    write_adjacency_lines(to_adjacency(part_next(spark, sf_dir), max_list=SHORT_LIST), path)
    return spark.read.text(path)


def _stored_graph(spark, edges: DataFrame):
    """The graph of an edge store that is written for the job."""
    path = fresh_folder(spark, "edges")
    write_edge_store(edges, path, buckets=STORE_BUCKETS)
    return open_graph(spark, path)


def q_mssp_edge_store(spark, sf_dir):
    """The two-source traversal on stored edges: each round reads the buckets
    that its frontier touches."""
    return shortest_paths(_stored_graph(spark, order_next(spark, sf_dir, ids="long")), list(SPARSE_SOURCES)).distances


def q_edge_store_scan(spark, sf_dir):
    """Every edge as the store's transposed side holds it."""
    return _stored_graph(spark, part_next(spark, sf_dir, ids="long")).store.scan("in").select(F.col("src").cast("string").alias("src"), F.col("dst").cast("string").alias("dst"))


def q_in_neighbors_edge_store(spark, sf_dir):
    """In-neighbours of parts on the dense graph, from the buckets that hold them."""
    return seed_from_in_neighbors(_stored_graph(spark, part_next(spark, sf_dir, ids="long")), list(MANY_SOURCES))


def q_mssp_continued(spark, sf_dir):
    """Stop after three rounds, open the log's last generation and go on."""
    log = fresh_folder(spark, "log")
    g = prepare_graph(order_next(spark, sf_dir, ids="long"))
    try:
        shortest_paths(g, urgent_orders(spark, sf_dir), stop_at_other_sources=True, max_rounds=STOPPED_AFTER_ROUNDS, log=log)
        continue_paths(g, log)
    finally:
        g.unpersist()
    return open_generation(spark, log).state()


def q_lsp_stored(spark, sf_dir):
    """Longest shortest path per urgent order, from the sums of a stored traversal."""
    log = fresh_folder(spark, "log")
    _on_graph(
        order_next(spark, sf_dir, ids="long"),
        lambda g: shortest_paths(g, urgent_orders(spark, sf_dir), stop_at_other_sources=True, log=log),
    )
    return stored_longest_paths(spark, log)


def q_mssp_bits(spark, sf_dir):
    return _on_graph(part_next(spark, sf_dir, ids="long"), lambda g: bit_paths(g, list(BIT_SOURCES)).distances)


def q_mssp_urgent_bits(spark, sf_dir):
    return _on_graph(
        order_next(spark, sf_dir, ids="long"),
        lambda g: bit_paths(g, urgent_orders(spark, sf_dir), stop_at_other_sources=True).distances,
    )


def q_lsp_bits(spark, sf_dir):
    return _on_graph(part_next(spark, sf_dir, ids="long"), lambda g: bit_paths(g, list(LSP_SOURCES)).longest())


def q_lsp_lines(spark, sf_dir):
    """Longest shortest path per source as ``source<TAB>lsp`` lines."""
    return summary_lines(longest_shortest_path(q_mssp(spark, sf_dir)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "edge_scan": q_edge_scan,
    "id_sample": q_id_sample,
    "induced_subgraph": q_induced_subgraph,
    "induced_by_frame": q_induced_by_frame,
    "sampled_adjacency": q_sampled_adjacency,
    "adjacency_to_edges": q_adjacency_to_edges,
    "seed_sources": q_seed_sources,
    "seed_in_neighbors": q_seed_in_neighbors,
    "relax_one_round": q_relax_one_round,
    "updated_count": q_updated_count,
    "sssp": q_sssp,
    "mssp": q_mssp,
    "mssp_dense": q_mssp_dense,
    "mssp_bottom_up": q_mssp_bottom_up,
    "mssp16": q_mssp16,
    "mssp_absorbing": q_mssp_absorbing,
    "mssp_urgent": q_mssp_urgent,
    "mssp_keys_and_reached": q_mssp_keys_and_reached,
    "mssp_resume": q_mssp_resume,
    "bounded_relaxation": q_bounded_relaxation,
    "bounded_dense": q_bounded_dense,
    "lsp_per_source": q_lsp_per_source,
    "lsp_global": q_lsp_global,
    "round_stats": q_round_stats,
    "diameter_lower_bound": q_diameter_lower_bound,
    "sampled_diameter": q_sampled_diameter,
    "adjacency_lines": q_adjacency_lines,
    "state_lines": q_state_lines,
    "distance_tuples": q_distance_tuples,
    "lsp_lines": q_lsp_lines,
    "edge_scan_malformed": q_edge_scan_malformed,
    "adjacency_file": q_adjacency_file,
    "mssp_edge_store": q_mssp_edge_store,
    "edge_store_scan": q_edge_store_scan,
    "in_neighbors_edge_store": q_in_neighbors_edge_store,
    "mssp_continued": q_mssp_continued,
    "lsp_stored": q_lsp_stored,
    "mssp_bits": q_mssp_bits,
    "mssp_urgent_bits": q_mssp_urgent_bits,
    "lsp_bits": q_lsp_bits,
}


# ======================================================================
# SQL side (DuckDB dialect, tables registered as views)
# ======================================================================
DENSE = (
    "SELECT DISTINCT CAST(l1.l_partkey AS VARCHAR) AS src, CAST(l2.l_partkey AS VARCHAR) AS dst "
    "FROM lineitem l1 JOIN lineitem l2 "
    "ON l1.l_orderkey = l2.l_orderkey AND l2.l_linenumber = l1.l_linenumber + 1 "
    "WHERE l1.l_partkey <> l2.l_partkey"
)
SPARSE = (
    "SELECT DISTINCT CAST(src AS VARCHAR) AS src, CAST(dst AS VARCHAR) AS dst FROM ("
    "SELECT o_orderkey AS src, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS dst "
    "FROM orders WHERE o_custkey IS NOT NULL AND o_orderkey IS NOT NULL) WHERE dst IS NOT NULL"
)
URGENT = "SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS source FROM orders WHERE o_orderpriority = '1-URGENT'"

SAMPLE_SQL = (
    "SELECT CAST(r AS VARCHAR) AS id FROM (SELECT unnest(range(0, (SELECT count(*) FROM part))) AS r) "
    f"ORDER BY md5('{SAMPLE_SEED}:' || CAST(r AS VARCHAR)), r "
    "LIMIT (SELECT count(*) // 4 FROM part)"
)

INDUCED_SQL = (
    f"WITH e AS ({DENSE}), s AS ({SAMPLE_SQL}) "
    "SELECT src, dst FROM e WHERE src IN (SELECT id FROM s) AND dst IN (SELECT id FROM s)"
)

ADJACENCY_SQL = (
    f"SELECT src AS vertex, string_agg(dst, ',' ORDER BY dst) AS neighbors FROM ({INDUCED_SQL}) GROUP BY src"
)


def _values(ids) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"('{i}')" for i in ids) + ") AS v(source)"


def _bfs_sql(edges: str, sources_sql: str, *, in_neighbors: bool = False, absorbing: bool = False,
             max_dist: int | None = None, select: str = "SELECT source, vertex, dist FROM r") -> str:
    """Breadth-first distances as a keyed recursive query: each step keeps
    the (source, vertex) pairs not reached before, so no hop cap is needed."""
    if in_neighbors:
        seeds = "SELECT s.source, e.src AS vertex, 1 AS dist FROM srcs s JOIN e ON e.dst = s.source"
    else:
        seeds = "SELECT source, source AS vertex, 0 AS dist FROM srcs WHERE source IN (SELECT src FROM e)"
    filters = ""
    if absorbing:
        filters += " AND (f.vertex = f.source OR f.vertex NOT IN (SELECT source FROM srcs))"
    if max_dist is not None:
        filters += f" AND f.dist < {max_dist}"
    return (
        f"WITH RECURSIVE e AS ({edges}), srcs AS ({sources_sql}), seeds AS ({seeds}), "
        "r(source, vertex, dist) USING KEY (source, vertex) AS ("
        "SELECT source, vertex, dist FROM seeds UNION "
        "(SELECT f.source, e.dst AS vertex, min(f.dist + 1) AS dist FROM r f JOIN e ON f.vertex = e.src "
        "WHERE NOT EXISTS (SELECT 1 FROM recurring.r v WHERE v.source = f.source AND v.vertex = e.dst)"
        f"{filters} GROUP BY f.source, e.dst)) "
        f"{select}"
    )


_DIST = "SELECT source, vertex, CAST(dist AS INTEGER) AS dist FROM r"
_LSP = "SELECT source, CAST(max(dist) AS INTEGER) AS lsp FROM r GROUP BY source"

MSSP_SQL = _bfs_sql(SPARSE, _values(SPARSE_SOURCES), select=_DIST)
MSSP16_SQL = _bfs_sql(DENSE, _values(MANY_SOURCES), select=_DIST)
BOUNDED_SQL = _bfs_sql(SPARSE, _values([BOUNDED_SOURCE]), in_neighbors=True,
                       max_dist=BOUNDED_ROUNDS + 1, select=_DIST)

_SEED_IN = (
    f"WITH e AS ({SPARSE}) SELECT '{BOUNDED_SOURCE}' AS source, src AS vertex, CAST(1 AS INTEGER) AS dist "
    f"FROM e WHERE dst = '{BOUNDED_SOURCE}'"
)
_RELAX_ONE = (
    f"WITH e AS ({SPARSE}), s AS ({_SEED_IN}), "
    "x AS (SELECT source, vertex, dist FROM s UNION ALL "
    "SELECT s.source, e.dst AS vertex, s.dist + 1 AS dist FROM s JOIN e ON s.vertex = e.src) "
    "SELECT source, vertex, CAST(min(dist) AS INTEGER) AS dist FROM x GROUP BY source, vertex"
)

_KEYS_AND_REACHED_ROWS = (
    "SELECT source, vertex, CAST(dist AS INTEGER) AS dist FROM r UNION ALL "
    "SELECT s.source, k.vertex, CAST(NULL AS INTEGER) AS dist "
    "FROM srcs s, (SELECT DISTINCT src AS vertex FROM e) k "
    "WHERE (k.vertex = s.source OR k.vertex NOT IN (SELECT source FROM srcs)) "
    "AND NOT EXISTS (SELECT 1 FROM r WHERE r.source = s.source AND r.vertex = k.vertex)"
)
_KEYS_AND_REACHED = _bfs_sql(SPARSE, _values(SPARSE_SOURCES), absorbing=True, select=_KEYS_AND_REACHED_ROWS)
_STATE_LINES = _bfs_sql(
    SPARSE, _values(SPARSE_SOURCES), absorbing=True,
    select=(
        "SELECT x.vertex || 'to' || x.source || chr(9) || "
        "CASE WHEN x.vertex <> x.source AND x.vertex IN (SELECT source FROM srcs) THEN 'null' ELSE coalesce(a.nb, 'null') END || ' ' "
        "|| CAST(coalesce(x.dist, 2147483647) AS VARCHAR) AS value "
        f"FROM ({_KEYS_AND_REACHED_ROWS}) x LEFT JOIN "
        "(SELECT src AS vertex, string_agg(dst, ',' ORDER BY dst) AS nb FROM e GROUP BY src) a "
        "ON a.vertex = x.vertex"
    ),
)
_DISTANCE_TUPLES = _bfs_sql(
    SPARSE, _values([BOUNDED_SOURCE]), in_neighbors=True,
    select=(
        "SELECT '(' || v.vertex || ',' || CAST(coalesce(r.dist, 2147483647) AS VARCHAR) || ')' AS value "
        "FROM (SELECT src AS vertex FROM e UNION SELECT dst FROM e) v LEFT JOIN r ON r.vertex = v.vertex"
    ),
)

_SAMPLED_TOP = (
    f"SELECT src AS source FROM ({INDUCED_SQL}) GROUP BY src ORDER BY count(*) DESC, src "
    f"LIMIT {TOP_SAMPLED_SOURCES}"
)

ORACLE_SQL: dict[str, str] = {
    "edge_scan": DENSE,
    "id_sample": SAMPLE_SQL,
    "induced_subgraph": INDUCED_SQL,
    "induced_by_frame": (
        f"WITH e AS ({DENSE}), s AS (SELECT CAST(p_partkey AS VARCHAR) AS id FROM part "
        "WHERE p_retailprice > (SELECT avg(p_retailprice) FROM part)) "
        "SELECT src, dst FROM e WHERE src IN (SELECT id FROM s) AND dst IN (SELECT id FROM s)"
    ),
    "sampled_adjacency": ADJACENCY_SQL,
    "adjacency_to_edges": (
        f"SELECT vertex AS src, unnest(string_split(neighbors, ',')) AS dst FROM ({ADJACENCY_SQL})"
    ),
    "seed_sources": (
        f"WITH e AS ({SPARSE}), srcs AS ({_values(SEED_SOURCES)}) "
        "SELECT source, source AS vertex, CAST(0 AS INTEGER) AS dist FROM srcs "
        "WHERE source IN (SELECT src FROM e)"
    ),
    "seed_in_neighbors": _SEED_IN,
    "relax_one_round": _RELAX_ONE,
    "updated_count": (
        f"WITH s AS ({_SEED_IN}), n AS ({_RELAX_ONE}) "
        "SELECT count(*) AS updated FROM n LEFT JOIN s ON n.source = s.source AND n.vertex = s.vertex "
        "WHERE s.dist IS NULL OR n.dist < s.dist"
    ),
    "sssp": _bfs_sql(DENSE, _values([DENSE_SOURCES[0]]), select=_DIST),
    "mssp": MSSP_SQL,
    "mssp_dense": _bfs_sql(DENSE, _values(DENSE_SOURCES), select=_DIST),
    "mssp_bottom_up": _bfs_sql(DENSE, _values(DENSE_SOURCES), select=_DIST),
    "mssp16": MSSP16_SQL,
    "mssp_absorbing": _bfs_sql(SPARSE, _values(SPARSE_SOURCES), absorbing=True, select=_DIST),
    "mssp_urgent": _bfs_sql(SPARSE, URGENT, absorbing=True, select=_DIST),
    "mssp_keys_and_reached": _KEYS_AND_REACHED,
    "mssp_resume": MSSP_SQL,
    "bounded_relaxation": BOUNDED_SQL,
    "bounded_dense": _bfs_sql(DENSE, _values([DENSE_SOURCES[0]]), in_neighbors=True,
                              max_dist=BOUNDED_ROUNDS + 1, select=_DIST),
    "lsp_per_source": _bfs_sql(SPARSE, _values(SPARSE_SOURCES), select=_LSP),
    "lsp_global": _bfs_sql(
        SPARSE, _values([BOUNDED_SOURCE]), in_neighbors=True,
        select="SELECT CAST(coalesce(max(dist), 0) AS INTEGER) AS lsp FROM r",
    ),
    "round_stats": _bfs_sql(
        SPARSE, _values(SPARSE_SOURCES),
        select=(
            "SELECT CAST(dist AS INTEGER) AS round, count(*) AS updated FROM r WHERE dist > 0 GROUP BY dist "
            "UNION ALL SELECT CAST(coalesce(max(dist), 0) + 1 AS INTEGER) AS round, CAST(0 AS BIGINT) AS updated FROM r"
        ),
    ),
    "diameter_lower_bound": _bfs_sql(
        DENSE, _values(MANY_SOURCES),
        select=f"SELECT CAST(coalesce(max(lsp), 0) AS INTEGER) AS diameter_lb FROM ({_LSP})",
    ),
    "sampled_diameter": _bfs_sql(f"SELECT src, dst FROM ({INDUCED_SQL})", _SAMPLED_TOP, select=_LSP),
    "adjacency_lines": f"SELECT vertex || chr(9) || neighbors AS value FROM ({ADJACENCY_SQL})",
    "state_lines": _STATE_LINES,
    "distance_tuples": _DISTANCE_TUPLES,
    "lsp_lines": _bfs_sql(
        SPARSE, _values(SPARSE_SOURCES),
        select=f"SELECT source || chr(9) || CAST(lsp AS VARCHAR) AS value FROM ({_LSP})",
    ),
    "edge_scan_malformed": (
        "SELECT CAST(o_orderkey AS VARCHAR) AS src, CAST(o_custkey AS VARCHAR) AS dst FROM orders "
        "WHERE o_orderpriority <> '5-LOW' AND o_custkey IS NOT NULL"
    ),
    "adjacency_file": f"SELECT src || chr(9) || string_agg(dst, ',' ORDER BY dst) AS value FROM ({DENSE}) GROUP BY src",
    "mssp_edge_store": MSSP_SQL,
    "edge_store_scan": DENSE,
    "in_neighbors_edge_store": (
        f"WITH e AS ({DENSE}), srcs AS ({_values(MANY_SOURCES)}) "
        "SELECT s.source, e.src AS vertex, CAST(1 AS INTEGER) AS dist FROM srcs s JOIN e ON e.dst = s.source"
    ),
    "mssp_continued": _bfs_sql(SPARSE, URGENT, absorbing=True, select=_DIST),
    "lsp_stored": _bfs_sql(SPARSE, URGENT, absorbing=True, select=_LSP),
    "mssp_bits": _bfs_sql(DENSE, _values(BIT_SOURCES), select=_DIST),
    "mssp_urgent_bits": _bfs_sql(SPARSE, URGENT, absorbing=True, select=_DIST),
    "lsp_bits": _bfs_sql(DENSE, _values(LSP_SOURCES), select=_LSP),
}
