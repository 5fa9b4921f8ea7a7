"""Column expressions: text, dates and numbers. No Python UDFs."""
