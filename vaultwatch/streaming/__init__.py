"""The two queries as Structured Streaming jobs."""
