"""Operators for large text corpora: each takes DataFrames, gives DataFrames, and keeps no whole table in one place."""
