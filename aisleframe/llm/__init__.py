"""Operators for preparing training text: filters, near-duplicate joins, extraction, scoring and encoding."""
