"""Whole-day runs and the queries over the driver tables."""
