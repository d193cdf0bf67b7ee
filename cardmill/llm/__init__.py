"""Training-data operators: packing, deduplication, quality, privacy, mixing, sharding, token files."""
