"""Column expressions: cleaning, word counting, reply handling."""
