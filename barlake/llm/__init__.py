"""Training-data operators: filtering, de-duplication, search, tokens, packing."""
