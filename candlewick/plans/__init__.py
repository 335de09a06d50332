"""Models and runs: Silver, Gold, serving queries, daily and backfill runs."""
