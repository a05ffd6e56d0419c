"""Operators on DataFrames: change detection, upserts, flags and key figures."""
