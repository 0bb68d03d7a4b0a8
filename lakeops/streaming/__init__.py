"""Structured Streaming entry points of the stateless operators."""
