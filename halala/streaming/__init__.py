"""Incremental work: load-once ingestion, latest copy merges, late rates."""
