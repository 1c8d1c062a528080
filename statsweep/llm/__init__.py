"""Training-data operators (deduplication, filters, extraction, tokenising). Nothing else in the library imports this."""
