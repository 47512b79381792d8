"""Tidemark: change capture and analytics for large document corpora on Spark."""

__version__ = "0.1.0"
