"""Structured Streaming entry points (an extension)."""
