"""Structured Streaming queries built from the operators."""
