"""Relational operators: latest-wins dedup, enrichment joins, grain, gap and quality checks."""
