"""Reusable relational patterns, schema-agnostic (they take column names)."""
