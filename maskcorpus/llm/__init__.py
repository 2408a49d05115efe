"""Training-data operators: formatting, near-duplicates, extraction, filters, mixing, encoding, archives."""
