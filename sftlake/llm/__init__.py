"""Operators for training-data pipelines: tokens, neighbours, quality, mixing, duplicates, languages, archives."""
