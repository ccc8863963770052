"""Operators for training data: deduplication, decontamination, mixing, filters."""
