"""Structured Streaming variants of the row-local decision operators."""
