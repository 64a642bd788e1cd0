"""Readers: stored dumps and files as DataFrames with fixed schemas."""
