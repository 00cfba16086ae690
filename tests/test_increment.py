"""The incremental load: what repeats, what fails half way, what has nothing new."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from tests.conftest import values

from lotcraft.plans.increment import append_increment, loaded
from lotcraft.sources import replace_partitions
from lotcraft.sources.staging import folder_exists

SCHEMA = "id long, name string, modified_date date"
DAY, NEXT = dt.date(2024, 3, 1), dt.date(2024, 3, 2)
OLD, RECENT = dt.date(2024, 1, 1), dt.date(2024, 2, 20)


@pytest.fixture
def table(tmp_path):
    return str(tmp_path / "table")


def held(spark, path, source):
    return values(loaded(spark, path, source.schema), "id", "name", "load_date")


def test_second_run_adds_nothing(spark, frame, table):
    source = frame(SCHEMA, (1, "a", RECENT), (1, "a", RECENT), (2, None, RECENT), (3, "old", OLD))
    assert append_increment(source, table, DAY).count() == 2
    first = held(spark, table, source)
    assert first == [(1, "a", DAY), (2, None, DAY)]
    assert append_increment(source, table, DAY).count() == 2  # the same load again
    assert held(spark, table, source) == first
    assert append_increment(source, table, NEXT).count() == 0  # the next load
    assert held(spark, table, source) == first
    assert not folder_exists(spark, f"{table}/load_date={NEXT}")


def test_only_new_rows_are_added_and_earlier_loads_stay(spark, frame, table):
    source = frame(SCHEMA, (1, "a", RECENT))
    append_increment(source, table, DAY)
    more = frame(SCHEMA, (1, "a", RECENT), (1, "b", RECENT))
    append_increment(more, table, NEXT)
    assert held(spark, table, source) == [(1, "a", DAY), (1, "b", NEXT)]
    assert {r.is_processed for r in loaded(spark, table, source.schema).collect()} == {False}


def test_rerun_after_a_failure_replaces_what_it_left(spark, frame, table):
    source = frame(SCHEMA, (1, "a", RECENT))
    append_increment(source, table, DAY)
    # A failed run left a row that another load has meanwhile, and one that is gone from the source.
    left = frame(SCHEMA, (1, "a", RECENT), (9, "gone", RECENT)).withColumns(
        {"is_processed": F.lit(False), "load_date": F.lit(NEXT)})
    replace_partitions(left, table, ["load_date"])
    append_increment(source, table, NEXT)
    assert held(spark, table, source) == [(1, "a", DAY)]
    both = frame(SCHEMA, (1, "a", RECENT), (2, "b", RECENT))
    replace_partitions(left, table, ["load_date"])
    append_increment(both, table, NEXT)
    assert held(spark, table, source) == [(1, "a", DAY), (2, "b", NEXT)]


def test_a_rejected_row_fails_before_the_table_is_touched(spark, frame, table):
    source = frame(SCHEMA, (1, "a", RECENT))
    append_increment(source, table, DAY)
    broken = frame("id string, name string, modified_date date", ("x", "a", RECENT)).select(
        F.col("id").cast("long").alias("id"), "name", "modified_date")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        append_increment(broken, table, NEXT)
    assert held(spark, table, source) == [(1, "a", DAY)]


def test_empty_source_and_reserved_names(spark, frame, table):
    empty = frame(SCHEMA)
    assert append_increment(empty, table, DAY).count() == 0
    assert held(spark, table, empty) == []
    with pytest.raises(ValueError, match="load_date"):
        append_increment(empty.withColumn("load_date", F.lit(DAY)), table, DAY)
