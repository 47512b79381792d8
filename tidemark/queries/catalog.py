"""All registered queries."""

from tidemark.queries import approval, corpus, files, operations, snapshots  # noqa: F401
from tidemark.queries.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
