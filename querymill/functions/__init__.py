"""Scalar functions: each takes and returns a ``Column``."""
