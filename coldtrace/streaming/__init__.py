"""Structured Streaming drivers, batch-versioned tables and monitoring."""
