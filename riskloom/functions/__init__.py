"""Column expressions with no state of their own."""
