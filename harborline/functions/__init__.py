"""Column expressions: every one stays in Spark's own expression set."""
