"""Operators: DataFrames and parameters in, one DataFrame out, for all branches in one job."""
