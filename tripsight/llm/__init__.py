"""Training-data operators and their queries (nothing else in the package imports this)."""
