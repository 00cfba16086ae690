"""Group values without gathering a group in one task.

A window over a raw key brings every row of that key to one task, which fails once a key
holds a large share of the table. The helpers here aggregate first, so that partial sums
leave each task and not rows, and join the group's values back to its rows.

The join compares keys null-safely. Its keys are then expressions, so both sides get an
exchange of their own, also the aggregated one, and adaptive execution is free to choose:
it broadcasts the values when their measured size is small, and otherwise splits the
partitions of a hot key over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = 1 << 16  # copies of a row made at once


def group_values(df: DataFrame, keys: Sequence[str], *values: Column) -> DataFrame:
    """One row per key with the aggregates."""
    return df.groupBy(*keys).agg(*values)


def attach_lookup(df: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join to `lookup`, which has one row per key; null keys match each other."""
    prefix = "_lookup_"
    names = [c for c in lookup.columns if c not in keys]
    side = lookup.select(*[F.col(k).alias(f"{prefix}{k}") for k in keys], *names)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])
    return df.join(side, same).select(*df.columns, *names)


def attach_group_values(df: DataFrame, keys: Sequence[str], *values: Column) -> DataFrame:
    """Every row with the aggregates of its group."""
    return attach_lookup(df, group_values(df, keys, *values), keys)


def latest_in_group(
    df: DataFrame, keys: Sequence[str], order: str, null_order: bool = True
) -> DataFrame:
    """Rows holding the largest `order` of their group, ties kept.

    With `null_order`, a group whose `order` is always null keeps its rows;
    without, such rows and rows with a null key are dropped.
    """
    top = attach_group_values(df, keys, F.max(order).alias("_top"))
    if null_order:
        return top.filter(F.col(order).eqNullSafe(F.col("_top"))).drop("_top")
    present = reduce(and_, [F.col(k).isNotNull() for k in keys])
    return top.filter(present & (F.col(order) == F.col("_top"))).drop("_top")


def one_row_per_group(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The smallest row of each group, compared over all its other columns."""
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    picked = df.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row"))
    return picked.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row `times` over, without the count; a row's list of turns is bounded."""
    last = F.col(times) - 1
    turns = F.sequence(F.lit(0).cast("bigint"), F.expr(f"({times} - 1) div {TURNS}"))
    within = F.sequence(F.lit(0).cast("bigint"),
                        F.least(last - F.col("_turn") * TURNS, F.lit(TURNS - 1).cast("bigint")))
    return (
        df.filter(F.col(times) > 0)
        .withColumn("_turn", F.explode(turns))
        .withColumn("_turn", F.explode(within))
        .drop("_turn", times)
    )


def unique_rows_only(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs once; every row of a repeated key goes. Null keys stay whole.

    One grouping reads the input once. The key of an incomplete row is extended by the whole
    row, so that such rows are spread by what they hold, counted, and repeated afterwards.
    """
    others = [c for c in df.columns if c not in keys]
    complete = reduce(and_, [F.col(k).isNotNull() for k in keys])
    packed = F.struct(*others) if others else F.struct(F.lit(1).alias("_one"))
    counted = (
        df.withColumns({"_whole": F.when(~complete, packed), "_row": F.when(complete, packed)})
        .groupBy(*keys, "_whole")
        .agg(F.count(F.lit(1)).alias("_rows"), F.any_value("_row").alias("_row"))
        .filter((F.col("_rows") == 1) | F.col("_whole").isNotNull())
    )
    row = F.coalesce("_whole", "_row")
    return repeat_rows(
        counted.withColumn("_row", row).select(
            *[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns], "_rows"
        ),
        "_rows",
    )
