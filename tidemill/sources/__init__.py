"""Batch text readers and stream sources."""
