"""Risk and value cohorts over snapshot loan facts, as plain Spark jobs."""
