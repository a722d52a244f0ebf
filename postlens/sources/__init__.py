"""Landed payloads to posts, stored tables, and sinks."""
