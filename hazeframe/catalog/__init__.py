"""All registered queries."""

from hazeframe.catalog import cleaning, io, models, ordered, profiles, reports, scoring, streams  # noqa: F401
from hazeframe.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
