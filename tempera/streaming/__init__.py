"""Structured Streaming twins of the batch transforms."""
