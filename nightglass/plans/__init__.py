"""Importing this package registers every query."""

from nightglass.plans import artifacts, corpus, detection, documents, history, streams  # noqa: F401
from nightglass.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
