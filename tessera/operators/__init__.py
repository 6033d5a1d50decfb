"""Reusable DataFrame operators (dedup, ranking, joins, quality, incremental)."""
