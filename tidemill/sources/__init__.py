"""Parsers of landed payloads."""
