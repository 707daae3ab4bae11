"""Quillstone: temporal facts, addressable text units and retrieval on Spark DataFrames."""

__version__ = "0.1.0"
