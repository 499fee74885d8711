"""Structured Streaming ingest of rating events."""
