"""Structured Streaming forms of the hourly, dedupe and cycle jobs."""
