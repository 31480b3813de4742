"""Structured Streaming variants of the loads."""
