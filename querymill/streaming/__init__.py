"""Jobs that take up what is new in a growing input."""
