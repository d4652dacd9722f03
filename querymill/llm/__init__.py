"""Operators and queries that prepare training text."""
