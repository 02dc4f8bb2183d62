"""Structured Streaming counterparts of the query-log operators."""
