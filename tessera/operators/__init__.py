"""Relational operators: DataFrames and column names in, a DataFrame out. No session, no path, no action."""
