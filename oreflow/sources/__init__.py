"""Readers and writers; all return or take plain DataFrames."""
