"""Operators for preparing training data: scoring, deduplication, filtering, mixing and formatting."""
