"""Operators: each takes DataFrames (or a Graph) and returns DataFrames or fitted models."""
