"""Registered queries: every operator bound to views over the given tables, with its DuckDB text."""
