"""Structured Streaming jobs and their incremental batch counterparts."""
