"""Registered queries: one module per group, each a table of (query, SQL that must give the same rows)."""
