"""Operators for building training data at scale: sharding, BPE, token files, near-duplicate
detection, mixing, line deduplication, vector search, toxicity and HTML extraction."""
