"""Operators: quality rules, versions, merges, keys, flags and reconciliation."""
