"""Structured Streaming runs of the same operators."""
