"""Column expressions: names, type labels, values and error texts."""
