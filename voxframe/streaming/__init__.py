"""Structured Streaming forms of the request, token, journal and shard operators."""
