"""Structured Streaming jobs that land raw topics into day folders."""
