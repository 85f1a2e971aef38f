"""Batch analytics for city service data on Spark DataFrames."""
