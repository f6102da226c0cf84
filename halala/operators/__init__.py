"""Relational operators built from DataFrame operations."""
