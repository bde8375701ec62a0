"""Training-data operators: packing, language, tokens, PII, deduplication, sharding, captures."""
