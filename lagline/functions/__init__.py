"""Column expressions and distributed numeric helpers."""
