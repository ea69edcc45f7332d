"""Training-data operators: tokens, near duplicates, language, quality, privacy."""
