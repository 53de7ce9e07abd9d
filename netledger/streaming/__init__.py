"""Structured Streaming versions of the settlement jobs."""
