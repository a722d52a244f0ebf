"""Column expressions: text, dates, labels."""
