"""Running totals over ordered rows, also where one group is too large for one task.

The rows are range-partitioned by group and order and written; each partition sums its own
rows, and the partitions' totals, one row a partition and group, become the offsets of the
partitions behind them. No task sees more than a range of the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotcraft.sources.staging import cut_lineage


def running_totals(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], totals: Mapping[str, Column]
) -> DataFrame:
    """Every row with the sums of `totals` over the rows of its group up to it, itself included.

    Null group values form a group. Rows equal in group and order stand in any sequence, so a
    definite result takes an order that tells rows apart. A sum over nulls only is null.
    """
    key = F.struct(*group)  # a struct is never null, so that null keys meet in a plain join
    dealt = cut_lineage(
        df.repartitionByRange(*[F.col(c) for c in group], *order)
        .withColumns({"_part": F.spark_partition_id(), "_key": key}), "scan")
    inside = (Window.partitionBy("_part", "_key").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = dealt.withColumns({f"_local_{name}": F.sum(value).over(inside) for name, value in totals.items()})
    parts = dealt.groupBy("_part", "_key").agg(
        *[F.sum(value).alias(f"_sum_{name}") for name, value in totals.items()])
    earlier = (Window.partitionBy("_key").orderBy("_part")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.select(
        "_part", "_key", *[F.sum(f"_sum_{name}").over(earlier).alias(f"_before_{name}") for name in totals])
    joined = local.join(offsets, ["_part", "_key"])
    sums = {}
    for name in totals:
        here, before = F.col(f"_local_{name}"), F.col(f"_before_{name}")
        sums[name] = F.when(before.isNull(), here).when(here.isNull(), before).otherwise(before + here)
    return joined.select(*df.columns, *[value.alias(name) for name, value in sums.items()])


def running_share(
    df: DataFrame,
    group: Sequence[str],
    item: Sequence[str],
    share: str,
    out: str,
    places: int = 2,
) -> DataFrame:
    """Running sum of a share within each group, rounded; largest first, ties by item, missing ones last.

    Shares of any sign count, and a group may hold any part of the rows: they are read once, dealt
    by ranges, and no task orders a whole group. A group without any share gets null.
    """
    order = [F.desc_nulls_last(share), *[F.asc(i) for i in item]]
    summed = running_totals(df, group, order, {"_running": F.col(share).cast("double")})
    return summed.withColumn(out, F.round("_running", places)).drop("_running")
