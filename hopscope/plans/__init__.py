"""Graph layout, session helpers and whole-job compositions."""
