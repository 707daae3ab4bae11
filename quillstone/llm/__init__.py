"""Operators for large-scale training data."""

from .queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
