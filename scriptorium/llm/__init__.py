"""Operators for training-data pipelines: deduplication, decontamination, privacy, scoring, tokens."""
