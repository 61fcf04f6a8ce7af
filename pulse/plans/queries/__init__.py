"""Queries over the test tables, each with the SQL it is checked against."""

from . import cleaning, dates, files, posts, scores, sets, streams, words  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
