"""Operators on DataFrames and on arrays of spans."""
