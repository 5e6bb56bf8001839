"""Column expressions and exact, bounded-state order statistics."""
