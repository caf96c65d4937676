"""Column expressions: predicates, time arithmetic and text."""
