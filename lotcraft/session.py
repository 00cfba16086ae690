"""Session settings the operators are written for."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Joins of raw rows rely on adaptive execution to split skewed partitions, also
# where the split costs one more shuffle for the operator above the join.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Sets of a few texts per group: keep hashing well beyond the default of 128 groups.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
    # A task that writes few folders keeps a file open in each instead of sorting its rows by
    # folder; beyond this number it sorts the rest.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session that already exists."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def joined_where_dealt(spark: SparkSession) -> Iterator[None]:
    """Joins run inside use the exchange their rows have, if it is by part of the join's keys.

    For frames that were dealt on purpose; elsewhere a join by all its keys spreads rows better.
    """
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)
