"""Training-data operators: deduplication, sharding, privacy, tokens, mixing, toxicity."""
