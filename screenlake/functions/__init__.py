"""Column expressions and the few Arrow-batched helpers."""
