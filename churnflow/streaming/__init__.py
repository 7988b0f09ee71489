"""Structured Streaming forms of scoring and monitoring."""
