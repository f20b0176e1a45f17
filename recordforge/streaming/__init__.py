"""Restartable incremental runs on Structured Streaming."""
