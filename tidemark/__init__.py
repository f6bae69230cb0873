"""Event and rating analytics on Spark: one set of DataFrame transforms for batch and streams."""
