"""Contextual document processing on Spark DataFrames."""
