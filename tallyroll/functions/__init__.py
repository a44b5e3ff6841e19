"""Column functions: field parsing, pay arithmetic, periods."""
