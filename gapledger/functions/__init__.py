"""Column expressions: dates and ranges, text."""
