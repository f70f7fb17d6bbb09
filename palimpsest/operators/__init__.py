"""Operators of the versioned store: lazy DataFrames in and out."""
