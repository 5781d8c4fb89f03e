"""Structured Streaming jobs; each has a batch twin among the operators."""
