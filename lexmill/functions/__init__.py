"""Column expressions: no shuffles, no state."""
