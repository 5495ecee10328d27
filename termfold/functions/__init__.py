"""Column expressions and the two Arrow UDFs."""
