"""Ordered-collection and metadata-catalog operators on Spark DataFrames."""
