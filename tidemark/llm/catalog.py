"""All registered queries of this subpackage."""

from tidemark.llm import audit, chat, decontam, langid, mixing, pii, quality, repeats, resample, simhash, topk, urls, warc  # noqa: F401
from tidemark.llm.common import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
