"""Structured Streaming runners of the batch operators."""
