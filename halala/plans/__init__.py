"""The thirteen tables, as functions from DataFrames to a DataFrame."""
