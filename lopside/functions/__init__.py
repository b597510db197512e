"""Column expressions: text, transaction features, numbers."""
