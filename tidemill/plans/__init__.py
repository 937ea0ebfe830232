"""Whole jobs, from input to results."""
