"""Column-level helpers; all of them are built from native Spark expressions."""
