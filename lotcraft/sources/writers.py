"""Sinks: published tables, CSV exports, payload files and snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

CSV_ROWS = 100_000


def publish(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
) -> None:
    """Parquet table, optionally one folder per value of the partition columns."""
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Write the partitions that `df` has rows of, and leave all others of the table as they are.

    A partition appears whole or stays what it was: repeating a write that failed, or that was
    already done, gives the same table.
    """
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def export_csv_chunks(df: DataFrame, path: str, rows: int = CSV_ROWS) -> None:
    """CSV files with a header and at most `rows` rows each."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("maxRecordsPerFile", rows)
        .csv(path)
    )


def write_payload(
    df: DataFrame, path: str, column: str, rows: int, partition_by: Sequence[str] = ()
) -> None:
    """One JSON object per line, at most `rows` lines per file."""
    writer = df.select(column, *partition_by).write.mode("overwrite")
    writer = writer.option("maxRecordsPerFile", rows)
    (writer.partitionBy(*partition_by) if partition_by else writer).text(path)


def write_snapshot(df: DataFrame, root: str, version: str) -> str:
    """A new version of a table in its own folder; an existing version is never replaced."""
    path = f"{root.rstrip('/')}/version={version}"
    df.write.mode("error").parquet(path)
    return path
