"""Column expressions: text, dates, themes and labels."""
