"""Set-based building blocks: dedup, percentiles, top-k, checks, enrichment."""
