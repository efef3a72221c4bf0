"""Operators for training-data pipelines: redaction, classifiers, tokens, duplicates, contamination, shards."""
