"""Training-data operators: packing, sketches, deduplication, filters, mixing, token and web archives."""
