"""Column functions: per-sample arithmetic, sizes and names."""
