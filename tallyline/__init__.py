"""Transaction matching and analytics as plain Spark DataFrame jobs."""
