"""Column expressions: tokens, markup, vectors, size checks."""
