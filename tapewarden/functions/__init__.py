"""Column builders. All are native Spark expressions."""
