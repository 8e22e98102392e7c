"""Training-data operators: scoring, deduplication, filtering, mixing, packing, formatting."""
