"""Incremental collection as a Structured Streaming job."""
