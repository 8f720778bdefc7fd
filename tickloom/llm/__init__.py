"""Operators for training-data pipelines: media, mixing, scans, archives, tokens, near-duplicates, language and scoring."""
