"""Training-data operators: quality, privacy, search, encoding, decontamination, scoring, mixing and deduplication."""
