"""Training-data operators: fingerprints, extraction, tokenizing, filters and deduplication of documents and pages."""
