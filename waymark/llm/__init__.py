"""Training-data operators: quality, archives, tokens, search and deduplication."""
