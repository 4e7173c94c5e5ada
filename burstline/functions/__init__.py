"""Column expressions: cleaning, tokens, n-grams."""
