"""The incremental load: a table that grows by one partition a load date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, StructField, StructType

from lotcraft.operators.incremental import append_new_rows
from lotcraft.sources.staging import cut_lineage, folder_exists
from lotcraft.sources.writers import replace_partitions

LOAD_DATE = "load_date"
FLAG = "is_processed"
WINDOW_DAYS = 30


def loaded(spark: SparkSession, path: str, source_schema: StructType) -> DataFrame:
    """The table at `path`, without rows before its first load."""
    schema = StructType([StructField(f.name, f.dataType) for f in source_schema])
    schema = schema.add(FLAG, BooleanType()).add(LOAD_DATE, DateType())
    if not folder_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def append_increment(
    source: DataFrame,
    path: str,
    load_date: dt.date,
    days: int = WINDOW_DAYS,
    date_column: str = "modified_date",
) -> DataFrame:
    """Append the rows of the last `days` days that the table lacks; returns what this load holds.

    A load is the partition of its date. It is compared with the other loads only and written
    whole, so that a load repeated after a failure, or run twice, leaves the same table, and a
    load without news writes nothing. A row that an earlier, unfinished run of the same date
    left behind goes if it is no longer new.
    """
    spark = source.sparkSession
    names = source.columns
    if {FLAG, LOAD_DATE} & set(names):
        raise ValueError(f"the source must not have the columns {FLAG} and {LOAD_DATE}")
    table = loaded(spark, path, source.schema)
    others = table.filter(F.col(LOAD_DATE) != F.lit(load_date)).drop(LOAD_DATE)
    since = load_date - dt.timedelta(days=days)
    new = append_new_rows(source, others, since, date_column, FLAG)
    # Written aside first: the table is read to find its own next partition.
    new = cut_lineage(new.withColumn(LOAD_DATE, F.lit(load_date)), "increment")
    own = table.filter(F.col(LOAD_DATE) == F.lit(load_date))
    if new.isEmpty() and not own.isEmpty():
        remove_partition(spark, path, load_date)
    else:
        replace_partitions(new, path, [LOAD_DATE])
    return new.select(*names, FLAG, LOAD_DATE)


def remove_partition(spark: SparkSession, path: str, load_date: dt.date) -> None:
    """Delete the folder of one load."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{LOAD_DATE}={load_date.isoformat()}")
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
