"""Incremental (Structured Streaming) form of the hourly job."""
