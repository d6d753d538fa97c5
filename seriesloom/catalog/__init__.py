"""Registered queries: each operator on the given tables, with an equivalent SQL statement where one exists."""

from . import composites, quality, relations, scoring, sources, statistics, streams, windows  # noqa: F401
from .base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
