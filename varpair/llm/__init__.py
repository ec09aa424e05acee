"""Corpus preparation operators for training text: quality, dedup, language, toxicity, tokens, packing."""
