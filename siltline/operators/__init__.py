"""Operators: DataFrames in, DataFrame out, nothing executed unless stated."""
