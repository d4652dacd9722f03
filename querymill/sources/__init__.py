"""Sources: each returns a lazy DataFrame."""
