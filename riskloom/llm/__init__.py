"""Training-data operators: tokens, toxicity, near duplicates, languages, licences, privacy, mixing, vector search."""
