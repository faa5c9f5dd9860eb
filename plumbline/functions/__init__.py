"""Scalar functions on columns: keys, periods, text and numbers."""
