"""Column expressions: grid cells, coordinate text, dates, small formatters."""
