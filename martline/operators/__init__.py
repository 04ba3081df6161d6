"""Warehouse operators: dimensions, facts, summaries, reports and sinks."""
