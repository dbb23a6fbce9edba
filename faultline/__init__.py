"""Batch and streaming analytics over timestamped sensor readings, on Spark DataFrames."""
