"""Operators: each takes DataFrames (plus plain parameters) and returns a DataFrame."""
