"""Structured Streaming variants of the log extractors."""
