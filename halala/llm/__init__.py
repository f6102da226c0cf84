"""Operators for training-data corpora: filters, duplicates, fingerprints, mixing and token files."""
