"""Column expressions: text cleaning, lenient casts, semi-structured access."""
