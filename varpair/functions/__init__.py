"""Column expressions used by the operators (no UDFs)."""
