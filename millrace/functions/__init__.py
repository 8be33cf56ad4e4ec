"""Column expressions: time, numbers, text."""
