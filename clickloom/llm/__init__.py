"""Operators for preparing training data, each on plain DataFrames."""
