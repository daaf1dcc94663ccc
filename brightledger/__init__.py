"""Batch analytics on Spark for large sets of published transaction records."""

__version__ = "0.1.0"
