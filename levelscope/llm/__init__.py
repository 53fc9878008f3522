"""Training-data operators: quality, deduplication, decontamination, tokens, sharding, scans."""
