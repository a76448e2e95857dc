"""Registered queries: each operator over the given tables, with the same result in ANSI SQL."""
