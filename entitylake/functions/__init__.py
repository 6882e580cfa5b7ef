"""Column expressions and schema paths."""
