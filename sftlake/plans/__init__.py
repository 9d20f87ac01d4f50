"""Query catalogue over the given tables."""
