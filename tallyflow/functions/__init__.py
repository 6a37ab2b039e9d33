"""Column expressions; all built-in functions, so they stay inside generated code."""
