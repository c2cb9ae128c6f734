"""Streaming-lakehouse analytics on Spark: landing, quality, gold tables, alerts."""

__version__ = "0.1.0"
