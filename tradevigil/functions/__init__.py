"""Column expressions: casts, flags and scores."""
