"""Operators for preparing text corpora at scale. Nothing else in the package imports this."""

from hazeframe.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
