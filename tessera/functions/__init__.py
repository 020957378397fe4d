"""Scalar functions: Columns in, a Column out."""
