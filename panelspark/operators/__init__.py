"""Operators on DataFrames and column names."""
