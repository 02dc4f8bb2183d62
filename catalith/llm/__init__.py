"""Training-data operators: search, deduplication, classification, tokens, packing."""
