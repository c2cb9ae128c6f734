"""Structured Streaming queries built on the batch column expressions."""
