"""Operators of a training-data pipeline: tokens, toxicity, duplicates, packing, fingerprints, chat text."""
