"""Live fleet and stop boards as Spark jobs."""
