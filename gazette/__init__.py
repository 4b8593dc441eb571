"""News-feed collection and article analytics as plain Spark jobs."""
