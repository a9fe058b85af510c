"""Command-line jobs: the same four jobs as the original programs, over the
same text layouts, run as ``spark-submit -m hopscope ...`` or
``python -m hopscope ...``.

    adjacency  EDGES OUTPUT K [--n N] [--start S] [--seed 0]
        edge list (src,dst lines) -> sample K ids from S..S+N-1 -> induced
        subgraph -> adjacency lists (vertex<TAB>n1,n2,...) in OUTPUT
    paths      ADJACENCY OUTPUT SOURCE [SOURCE ...] [--absorbing] [--max-rounds R]
        hop distances to the fixpoint from every source: OUTPUT/state
        (vertex"to"source<TAB>list dist, infinity as 2147483647),
        OUTPUT/lsp (source<TAB>longest), OUTPUT/rounds (round<TAB>updated)
    resume     ADJACENCY STATE OUTPUT [--absorbing] SOURCE [SOURCE ...]
        continue from a saved state (text layout), same outputs as paths
        paths takes --log DIR: each round is kept there
    continue   ADJACENCY LOG OUTPUT
        take a traversal up from the last whole generation of its log
    summary    LOG OUTPUT
        OUTPUT/lsp from a log's records, without reading its rows
    bounded    ADJACENCY OUTPUT SOURCE [--rounds R]
        in-neighbour-seeded relaxation: OUTPUT/distances ((vertex,dist)
        tuples for every vertex) and OUTPUT/lsp (one number, unreachable
        counted as 0)

Every output is a distributed write (mode overwrite). Checkpoints go to the
session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from hopscope.operators.adjacency import to_edges
from hopscope.operators.summary import longest_shortest_path
from hopscope.operators.traversal import bounded_relaxation, continue_paths, resume_shortest_paths, shortest_paths
from hopscope.plans.generations import stored_longest_paths
from hopscope.plans.graph import prepare_graph
from hopscope.plans.pipeline import build_sampled_adjacency
from hopscope.sources.line_writer import write_adjacency_lines
from hopscope.sources.sinks import distance_lines, state_lines, summary_lines
from hopscope.sources.text import read_adjacency, read_edges, read_state

# Fixed value: the id range the original adjacency job samples from when no
# range is given (ids 1 .. 11316811).
DEFAULT_ID_RANGE = 11_316_811


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="hopscope", description="hop-distance jobs on Spark")
    sub = ap.add_subparsers(dest="job", required=True)

    a = sub.add_parser("adjacency", help="sampled adjacency lists from an edge list")
    a.add_argument("edges")
    a.add_argument("output")
    a.add_argument("k", type=int)
    a.add_argument("--n", type=int, default=DEFAULT_ID_RANGE, help="size of the id range to sample from")
    a.add_argument("--start", type=int, default=1, help="first id of the range")
    a.add_argument("--seed", type=int, default=0)

    p = sub.add_parser("paths", help="hop distances to the fixpoint")
    p.add_argument("adjacency")
    p.add_argument("output")
    p.add_argument("sources", nargs="+")
    p.add_argument("--absorbing", action="store_true", help="sources do not expand in other sources' traversals")
    p.add_argument("--max-rounds", type=int, default=None)
    p.add_argument("--log", default=None, help="folder in which each round is kept")

    c = sub.add_parser("continue", help="take up a logged traversal")
    c.add_argument("adjacency")
    c.add_argument("log")
    c.add_argument("output")

    s = sub.add_parser("summary", help="longest shortest paths of a logged traversal")
    s.add_argument("log")
    s.add_argument("output")

    r = sub.add_parser("resume", help="continue a traversal from saved state")
    r.add_argument("adjacency")
    r.add_argument("state")
    r.add_argument("output")
    r.add_argument("sources", nargs="+")
    r.add_argument("--absorbing", action="store_true")

    b = sub.add_parser("bounded", help="in-neighbour-seeded bounded relaxation")
    b.add_argument("adjacency")
    b.add_argument("output")
    b.add_argument("source")
    b.add_argument("--rounds", type=int, default=None, help="stop after so many rounds; default: the fixpoint")
    return ap


def _write_traversal(t, adjacency, output: str, absorbing: bool) -> None:
    full = t.with_unreached("keys_and_reached")
    state_lines(full, adjacency, stop_at_other_sources=absorbing).write.mode("overwrite").text(f"{output}/state")
    summary_lines(longest_shortest_path(t.distances)).write.mode("overwrite").text(f"{output}/lsp")
    t.stats_frame().select(F.concat_ws("\t", "round", "updated").alias("value")).write.mode("overwrite").text(
        f"{output}/rounds"
    )


def run(spark: SparkSession, argv: list[str]) -> None:
    args = _parser().parse_args(argv)
    if args.job == "adjacency":
        edges = read_edges(spark, args.edges)
        adj = build_sampled_adjacency(edges, args.k, args.n, seed=args.seed, start=args.start)
        write_adjacency_lines(adj, args.output)
        return
    if args.job == "summary":
        summary_lines(stored_longest_paths(spark, args.log)).write.mode("overwrite").text(f"{args.output}/lsp")
        return
    adjacency = read_adjacency(spark, args.adjacency)
    graph = prepare_graph(to_edges(adjacency))
    if args.job == "paths":
        t = shortest_paths(graph, args.sources, stop_at_other_sources=args.absorbing, max_rounds=args.max_rounds, log=args.log)
        _write_traversal(t, adjacency, args.output, args.absorbing)
    elif args.job == "continue":
        t = continue_paths(graph, args.log)
        _write_traversal(t, adjacency, args.output, t.absorbing)
    elif args.job == "resume":
        state = read_state(spark, args.state, fmt="text", sources=args.sources)
        t = resume_shortest_paths(graph, state, sources=args.sources, stop_at_other_sources=args.absorbing)
        _write_traversal(t, adjacency, args.output, args.absorbing)
    elif args.job == "bounded":
        t = bounded_relaxation(graph, [args.source], rounds=args.rounds)
        if not t.converged:
            print(f"stopped after {args.rounds} rounds before the fixpoint: vertices further away are written as unreachable")
        full = t.with_unreached("all")
        distance_lines(full, with_source=False).write.mode("overwrite").text(f"{args.output}/distances")
        lsp = longest_shortest_path(full, per_source=False, unreachable_as_zero=True)
        summary_lines(lsp).write.mode("overwrite").text(f"{args.output}/lsp")


def main(argv: list[str] | None = None) -> None:
    spark = SparkSession.builder.appName("hopscope").getOrCreate()
    run(spark, sys.argv[1:] if argv is None else argv)


if __name__ == "__main__":
    main()
