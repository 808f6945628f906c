"""Relational building blocks: preferred rows, lookups, rollups, quality checks."""
