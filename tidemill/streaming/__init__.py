"""Structured Streaming variants."""
