"""Column expressions, predicates and user-defined functions."""
