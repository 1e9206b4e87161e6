"""Structured Streaming wrappers of the incremental jobs."""
