"""Batch and streaming mart building blocks on Spark DataFrames."""

__version__ = "0.1.0"
