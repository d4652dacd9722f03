"""Sinks: each writes a DataFrame (or a fitted model) and says where it went."""
