"""Column-expression helpers (parsing, rules, derived columns)."""
