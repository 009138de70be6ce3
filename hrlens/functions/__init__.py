"""Column-expression helpers (all built-in Spark SQL functions)."""
