"""Column expressions: periods, measures, text."""
