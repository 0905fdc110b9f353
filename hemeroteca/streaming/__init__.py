"""Structured Streaming forms of the harvest."""
