"""Queries of the operators over the test tables, and their SQL equivalents."""

from catalog import (  # noqa: F401
    conform_queries,
    mpq_queries,
    plan_queries,
    planning_queries,
    quality_queries,
    template_queries,
)
from catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
