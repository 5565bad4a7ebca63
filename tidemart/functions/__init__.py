"""Column expressions: dates, casts, exact arithmetic, units, labels."""
