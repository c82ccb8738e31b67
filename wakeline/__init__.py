"""Wakeline: vessel-position analytics written as plain PySpark DataFrame work."""

__version__ = "0.1.0"
