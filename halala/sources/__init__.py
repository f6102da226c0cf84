"""Delivered files and warehouse tables."""
