"""Operators for training-data pipelines: tokens, language models, near-duplicates, filters, mixing."""
