"""Structured Streaming wrappers around the row-level functions."""
