"""Structured Streaming entry to the landing load."""
