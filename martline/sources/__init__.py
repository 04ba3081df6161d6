"""Readers for landed files and databases, and their schemas."""
