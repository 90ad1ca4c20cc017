"""Structured Streaming versions of the file-driven jobs."""
