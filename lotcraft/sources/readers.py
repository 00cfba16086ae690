"""Readers for ticket extracts and typed tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lotcraft.operators.conform import cast_columns, sanitize_columns


def text_schema(names: list[str]) -> StructType:
    """All-string schema: extracts are typed later, by hand."""
    return StructType([StructField(n, StringType()) for n in names])


def read_pipe_csv(
    spark: SparkSession, path: str | list[str], schema: StructType | None = None,
    broken_lines: bool = True,
) -> DataFrame:
    """Pipe-delimited extract with a header; quoted fields may span lines.

    A quoted line break makes a file unsplittable, so one file is one task: large
    extracts should arrive as many files, or be read with `broken_lines=False` where no
    field holds a line break, which deals one file over many tasks. Without a schema only the header line is read
    ahead, and every column is a string.
    """
    reader = (
        spark.read.option("header", True)
        .option("multiLine", broken_lines)
        .option("sep", "|")
        .option("quote", '"')
        .option("escape", '"')
    )
    return (reader.schema(schema) if schema else reader).csv(path)


def _extract_names(spark: SparkSession, directory: str) -> list[str]:
    """Names of the CSV files or folders in a directory; only the listing is read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(directory)
    )
    folder = re.escape(directory.rstrip("/").split("/")[-1])
    inside = F.regexp_extract("path", f"/{folder}/([^/]+)", 1)
    return sorted(r["name"] for r in files.select(inside.alias("name")).distinct().collect())


def load_csv_dir(
    spark: SparkSession,
    directory: str,
    types: dict[str, dict[str, str]] | None = None,
    broken_lines: bool = True,
) -> dict[str, DataFrame]:
    """One table per CSV file of a directory, with clean names and chosen column types."""
    tables = {}
    for name in _extract_names(spark, directory):
        table = name.removesuffix(".csv").replace(".", "_")
        df = sanitize_columns(read_pipe_csv(
            spark, f"{directory.rstrip('/')}/{name}", broken_lines=broken_lines))
        tables[table] = cast_columns(df, (types or {}).get(table, {}))
    return tables


def read_merged_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet whose files may differ in their columns."""
    return spark.read.option("mergeSchema", True).parquet(path)
