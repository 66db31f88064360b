"""Column-level building blocks: null-safe scalars, right-closed bins, exact order statistics."""
