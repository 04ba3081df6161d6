"""Reusable column expressions and change-feed predicates."""
