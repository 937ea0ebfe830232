"""Column expressions and integer ids."""
