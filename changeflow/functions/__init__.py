"""Column-level helpers: ordered neighbours, comparisons, session functions."""
