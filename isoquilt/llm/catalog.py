"""Importing this module registers the queries of the subpackage."""

from isoquilt.llm import queries, queries_corpus  # noqa: F401
from isoquilt.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
