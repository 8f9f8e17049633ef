"""Operators and pipelines of a streaming warehouse, expressed on Spark DataFrames."""
