"""Column expressions: safe arithmetic, name parsing, periods, labels."""
