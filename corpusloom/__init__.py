"""Text-corpus preparation, measurement and run-log analytics as Spark jobs."""
