"""Structured Streaming front end."""
