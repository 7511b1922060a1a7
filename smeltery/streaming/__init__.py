"""Incremental file intake with Structured Streaming."""
