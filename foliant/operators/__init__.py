"""Relational operators: DataFrames in, DataFrames out, nothing collected unless a docstring says what and how little."""
