"""Training-data operators: mixing, quality, search, toxicity, deduplication, packing, chat."""
