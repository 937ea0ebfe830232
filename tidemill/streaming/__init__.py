"""Structured Streaming counts."""
