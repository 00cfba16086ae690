"""Where the queries register themselves with their SQL equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.domain import Frames, frames, with_frames

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of `Frames` as a query; `sql` may name frames in braces."""

    def register(function: Callable[[Frames], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: function(frames(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_frames(sql)
        return function

    return register


def rounded(column: str | Column, places: int = 4) -> Column:
    """Value for comparison: rounded as a decimal, so that the last bits of a sum do not show."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column.cast("decimal(38,10)"), places).cast("double")


def R(expression: str, places: int = 4) -> str:  # noqa: N802
    """The same rounding in SQL."""
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(38,10)), {places}) AS DOUBLE)"
