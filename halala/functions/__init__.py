"""Column expressions shared by the plans."""
