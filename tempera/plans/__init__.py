"""Complete queries over the given tables."""
