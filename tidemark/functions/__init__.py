"""Column expressions: calendar parts and small scalar functions."""
