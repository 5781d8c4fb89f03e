"""Operators: DataFrames in, DataFrames out, lazily unless a docstring says otherwise."""
