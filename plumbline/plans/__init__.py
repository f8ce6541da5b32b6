"""Whole jobs: from a table to models, metrics and recommendations."""
