"""hopscope: hop-distance analytics on large directed graphs held as tables.

Everything is DataFrame code: joins, aggregations, checkpoints. See the
README for the operator list.
"""

from hopscope.operators.adjacency import adjacency_text, to_adjacency, to_edges
from hopscope.operators.bitsets import BitTraversal, bit_paths
from hopscope.operators.sampling import (
    HashCut,
    IdSample,
    draw_ids,
    draw_vertices,
    sample_ids,
    sample_vertices,
    smallest_by_hash,
)
from hopscope.operators.subgraph import induced_subgraph
from hopscope.operators.summary import diameter_lower_bound, distance_histogram, longest_shortest_path
from hopscope.operators.traversal import (
    Traversal,
    bounded_relaxation,
    continue_paths,
    expand,
    iterate,
    relax_round,
    resume_shortest_paths,
    seed_from_in_neighbors,
    seed_from_sources,
    shortest_paths,
    source_set,
    updated_count,
)
from hopscope.plans.edge_store import EdgeStore, open_edge_store, open_graph, write_edge_store
from hopscope.plans.generations import Generation, open_generation, stored_longest_paths
from hopscope.plans.graph import HopGraph, prepare_graph
from hopscope.plans.pipeline import build_sampled_adjacency, estimate_diameter, sampled_subgraph
from hopscope.plans.session import checkpoint_dir
from hopscope.sources.line_writer import write_adjacency_lines
from hopscope.sources.sinks import write_adjacency, write_distances, write_state, write_summary
from hopscope.sources.text import (
    count_malformed_adjacency_lines,
    count_malformed_edge_lines,
    parse_adjacency_lines,
    parse_edge_lines,
    parse_state_lines,
    read_adjacency,
    read_edges,
    read_state,
)

__all__ = [name for name in dir() if not name.startswith("_")]
