"""Column expressions: calendar, bands, text."""
