"""Checks before load and after build."""
