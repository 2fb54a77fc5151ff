"""Relational building blocks: ranking, skew-safe joins, linking, matching and reports."""
