"""Column-level helpers (native Spark expressions only)."""
