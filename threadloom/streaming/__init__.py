"""Structured Streaming forms of the dialogue operators."""
