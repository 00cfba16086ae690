"""Incremental load and reminder state, kept as snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotcraft.operators.quality import REMINDER_KEYS, is_overdue, join_history


def append_new_rows(
    source: DataFrame,
    target: DataFrame,
    since: dt.date,
    date_column: str = "modified_date",
    flag: str = "is_processed",
) -> DataFrame:
    """Rows of the source since a date that the target lacks, once each, marked unprocessed.

    Only target rows since the same date can equal a source row, so the bound prunes both
    scans. One grouping over all columns, nulls equal, does the rest: copies combine before
    its shuffle, and a row seen in the target is left out.
    """
    bound = F.col(date_column) >= F.lit(since)
    columns = source.columns
    recent = source.filter(bound).withColumn("_known", F.lit(0))
    known = target.select(*columns).filter(bound).withColumn("_known", F.lit(1))
    seen = recent.unionByName(known).groupBy(*columns).agg(F.max("_known").alias("_known"))
    return seen.filter(F.col("_known") == 0).drop("_known").withColumn(flag, F.lit(False))


def advance_reminder_history(
    summary: DataFrame,
    history: DataFrame,
    as_of: dt.date,
    deadline: str = "supplier_deadline_date",
    seed: bool = True,
) -> DataFrame:
    """Next reminder state: overdue tickets with their counter raised by one.

    On a weekend no reminder goes out, so the history stays as it is.

    Without `seed`, the counters of the existing history are raised and nothing is added.
    The result is a new snapshot, written beside the one that was read.
    """
    if as_of.weekday() >= 5:
        return history
    if not seed:
        return history.withColumn("last_reminder", F.col("last_reminder") + 1)
    overdue = summary.filter(is_overdue(as_of, deadline))
    joined = join_history(overdue, history, deadline)
    counter = (F.coalesce(F.col("last_reminder"), F.lit(0)) + 1).cast("int")
    return joined.select(
        *[F.col(deadline).alias(k) if k == "supplier_deadline_date" else F.col(k)
          for k in REMINDER_KEYS],
        counter.alias("last_reminder"),
    )
