"""Arriving files and arriving claims with Structured Streaming."""
