"""Column functions: predicates and scalar expressions."""
