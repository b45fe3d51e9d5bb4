"""Transformations: DataFrames and declared specs in, DataFrames out."""
