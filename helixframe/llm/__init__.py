"""Training-data operators: media, packing, deduplication, scoring, search, mixing."""
