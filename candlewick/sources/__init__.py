"""Reading: raw API payloads, Bronze Parquet (ours and drifted), and the benchmark tables."""
