"""Whole jobs composed from the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from hopscope.functions.expressions import DEFAULT_SAMPLE_SEED
from hopscope.operators.adjacency import MAX_LIST, to_adjacency
from hopscope.operators.sampling import draw_ids
from hopscope.operators.subgraph import induced_subgraph
from hopscope.operators.summary import diameter_lower_bound, longest_shortest_path
from hopscope.operators.traversal import Traversal, shortest_paths
from hopscope.plans.graph import prepare_graph


def sampled_subgraph(edges: DataFrame, k: int, n: int, seed: int = DEFAULT_SAMPLE_SEED, start: int = 1) -> DataFrame:
    """Edges among ``k`` ids drawn from ``start .. start + n - 1``."""
    return induced_subgraph(edges, draw_ids(edges.sparkSession, k, n, seed=seed, start=start))


def build_sampled_adjacency(edges: DataFrame, k: int, n: int, seed: int = DEFAULT_SAMPLE_SEED,
                            start: int = 1, max_list: int = MAX_LIST) -> DataFrame:
    """Sample ``k`` ids, keep the edges among them, and group them into
    adjacency lists ``(vertex, neighbors)``. Vertices without a sampled
    out-edge get no row."""
    return to_adjacency(sampled_subgraph(edges, k, n, seed=seed, start=start), max_list=max_list)


@dataclass
class DiameterEstimate:
    traversal: Traversal
    lsp: DataFrame            # (source, lsp)
    diameter_lb: DataFrame    # one row


def estimate_diameter(edges: DataFrame, sources, *, stop_at_other_sources: bool = False,
                      partitions: int | None = None) -> DiameterEstimate:
    """Hop distances from ``sources`` to the fixpoint, the longest shortest
    path of each source, and the largest of them as a diameter lower bound."""
    graph = prepare_graph(edges, partitions=partitions)
    t = shortest_paths(graph, sources, stop_at_other_sources=stop_at_other_sources)
    lsp = longest_shortest_path(t.distances)
    return DiameterEstimate(t, lsp, diameter_lower_bound(lsp))
