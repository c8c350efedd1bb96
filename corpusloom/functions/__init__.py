"""Column functions on text."""
