"""Readers, writers, named tables and stream sources."""
