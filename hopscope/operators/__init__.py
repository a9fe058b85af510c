"""Graph operators: sampling, induced subgraph, adjacency, traversal, summaries."""
