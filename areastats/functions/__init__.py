"""Column expressions: numbers, text, projection and geometry."""
