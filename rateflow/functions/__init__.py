"""Column expressions for the per-line features; all built-in, no Python UDFs."""
