"""Running totals that no single task holds."""

from __future__ import annotations

import pytest
from tests.conftest import values
from pyspark.sql import functions as F

from lotcraft.functions.scan import running_totals


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_running_totals_cross_partitions(spark, frame, partitions):
    rows = [("a" if i % 3 else None, i, float(i % 5) if i % 7 else None) for i in range(400)] + [("z", 1, None)]
    expected, sums, counts = [], {}, {}
    for group, place, value in sorted(rows, key=lambda r: r[1]):
        counts[group] = counts.get(group, 0) + 1
        if value is not None:
            sums[group] = sums.get(group, 0.0) + value
        expected.append((group, place, value, counts[group], sums.get(group)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = running_totals(frame("g string, i int, v double", *rows), ["g"], [F.col("i")],
                             {"n": F.lit(1), "total": F.col("v")})
        assert values(got) == sorted(expected, key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
