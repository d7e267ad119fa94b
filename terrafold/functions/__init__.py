"""Column expressions and Arrow-batched geometry helpers."""
