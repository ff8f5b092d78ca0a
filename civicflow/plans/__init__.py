"""Data products (P1-P12): functions from DataFrames to DataFrames."""
