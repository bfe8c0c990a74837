"""Joins, windows, aggregates and set operations on DataFrames."""
