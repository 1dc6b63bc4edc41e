"""Operators that prepare training text: counting, formatting, deduplication, filtering."""
