"""Operators for building training data from text, each on plain DataFrames."""
