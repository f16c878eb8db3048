"""Column expressions: time text, casts, map and set helpers."""
