"""Estimators, tuning and metrics."""
