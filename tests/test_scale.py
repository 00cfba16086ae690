"""Plans hold for hot keys and large tables."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from catalog.conform_queries import _family_quotation
from catalog.domain import frames
from lotcraft import schemas as S
from lotcraft.functions import attach_group_values, unique_rows_only
from lotcraft.operators import conform as C
from lotcraft.operators import payload as Y
from lotcraft.operators import planning as P
from lotcraft.operators import quality as Q

SF_DIR = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df):
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture
def settings(spark):
    """Set session options for one test."""
    before = {}

    def set_all(**options):
        for name, value in options.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_all
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def _skewed(spark, rows=400_000):
    """A third of the rows share one key and are exact copies of one another."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, rows, 1, 16).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("k"),
        F.when(hot, 1.0).otherwise(F.col("id").cast("double")).alias("v"),
        F.lit("x" * 40).alias("pad"),
    )


def test_group_values_of_a_hot_key_are_split_over_tasks(spark, settings):
    settings(**{
        "spark__sql__autoBroadcastJoinThreshold": "-1",
        "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "200KB",
        "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "100KB",
    })
    out = attach_group_values(_skewed(spark), ["k"], F.sum("v").alias("total"),
                              F.count(F.lit(1)).alias("n"))
    checked = out.groupBy("k").agg(F.count(F.lit(1)).alias("rows"), F.max("n").alias("n"))
    rows = checked.collect()
    assert all(r["rows"] == r["n"] for r in rows)
    assert sum(r["rows"] for r in rows) == 400_000
    plan = _plan(checked)
    assert "skew=true" in plan or "skewed" in plan


def test_latest_rows_of_a_hot_key_stay_whole(spark):
    df = _skewed(spark, 60_000).withColumn("ticket_id", F.lit("t"))
    assert P.latest_by_rank(df, ["k"]).count() == 60_000


ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _modules():
    """(folder, name) of the table library's modules; the operators over text, a part of their
    own that may be absent, run Python in tasks and are held to bounds by tests beside them."""
    for folder, inner, names in os.walk(os.path.join(ROOT, "lotcraft")):
        if "llm" in inner:
            inner.remove("llm")
        for name in names:
            if name.endswith(".py"):
                yield folder, name


def test_no_window_over_raw_groups():
    """Ordered windows remain only where the rows of a group are few."""
    using = [
        os.path.relpath(os.path.join(folder, name), os.path.join(ROOT, "lotcraft"))
        for folder, name in _modules()
        if re.search(r"Window\.partitionBy", open(os.path.join(folder, name)).read())
    ]
    # Running totals within a range of the rows and over one row a range, and the order inside a
    # spot of the digest and inside a bucket of the payload, both as many as the rows need.
    assert sorted(using) == ["functions/scan.py", "operators/payload.py", "operators/quality.py"]


def test_no_row_reaches_the_driver_or_python():
    banned = re.compile(r"\.collect\(\)|toPandas|udf\(|\.rdd\b|crossJoin|localCheckpoint|broadcast\(")
    for folder, name in _modules():
        # The reader collects file names, nothing else.
        if name != "readers.py":
            assert not banned.search(open(os.path.join(folder, name)).read()), name


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
def test_scan_reads_only_what_the_query_needs(spark):
    plan = _plan(driver.queries()["spend_and_share"](spark, SF_DIR))
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    # Ticket, price factor and forecast of the line; family and price of the part.
    assert {"l_partkey:bigint,l_suppkey:bigint,l_quantity:double,l_tax:double",
            "p_partkey:bigint,p_brand:string,p_size:int,p_retailprice:double"} == set(read)


def test_date_bound_reaches_the_scan(spark, frame, tmp_path):
    import datetime as dt

    df = frame("material_id string, requirement_date_for_the_component string,"
               "sum_total_requirement_qty double", ("a", "20240101", 1.0))
    df.write.parquet(str(tmp_path / "c"))
    cons = spark.read.parquet(str(tmp_path / "c"))
    plan = _formatted(P.consumption_within_days(cons, ["material_id"], 91, dt.date(2024, 1, 1)))
    assert "LessThanOrEqual(requirement_date_for_the_component,20240401)" in plan
    horizons = P.consumption_month_horizons(
        cons.withColumn("material_type", F.lit("ROH")), dt.date(2024, 1, 1), keys=["material_id"])
    assert "GreaterThanOrEqual(requirement_date_for_the_component,202401)" in _formatted(horizons)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
def test_search_groups_on_hash_tables(spark):
    plan = _plan(driver.queries()["optimal_mpq"](spark, SF_DIR))
    above_explode = plan.split("Generate explode")[0]
    first = above_explode.rstrip().split("HashAggregate")[-1]
    assert "SortAggregate" not in first and "Exchange" not in first


def _scans(df):
    """Reads of the input in the plan as it will run, reused exchanges apart."""
    return len(re.findall(r"Scan (?:ExistingRDD|parquet|json|csv)|LocalTableScan", _plan(df)))


def test_scales_and_ambiguous_rows_are_read_once(spark, tmp_path):
    path = str(tmp_path / "scale")
    spark.createDataFrame([("t", "1", "F", 5)], "k string, m string, f string, n int"
                          ).write.parquet(path)
    assert _scans(unique_rows_only(spark.read.parquet(path), ["k", "m"])) == 1

    scale = spark.createDataFrame([], ", ".join(f"{c} string" for c in S.SCALE_FACT_COLUMNS))
    scale.write.parquet(path + "-raw")
    summary = spark.createDataFrame(
        [], "ticket_id string, supplier_input_ticket_id string, scale_scenario_type string,"
            "ticket_owner string")
    summary.write.parquet(path + "-summary")
    entries = spark.createDataFrame(
        [], "ticket_id string, material_id string, price_scale_fam_name string")
    entries.write.parquet(path + "-input")
    read = {n: spark.read.parquet(f"{path}-{n}") for n in ("raw", "summary", "input")}
    out = C.resolve_price_scale(read["raw"], read["summary"], read["input"])
    assert _scans(out) == 3 and out.count() == 0


def test_scales_cross_the_network_once_before_they_match(spark, settings, frame):
    settings(**{"spark__sql__autoBroadcastJoinThreshold": "-1"})
    columns = S.SCALE_FACT_COLUMNS

    def scale(ticket, material, family):
        given = {"ticket_id": ticket, "material_id": material, "scale_fam": family}
        return tuple(given.get(c) for c in columns)

    raw = frame(", ".join(f"{c} string" for c in columns), scale("t", "1", "F"), scale("t", None, "F"),
                scale("t", None, "F"), scale("t", " ", "F"), scale("u", "9", " "), scale(None, "1", "F"))
    # A ticket of both scenarios, one of none, and one that names two inputs.
    summary = frame("ticket_id string, supplier_input_ticket_id string, scale_scenario_type string,"
                    "ticket_owner string", ("t", "i", "1", "o"), ("t", "i", "2", "o"), ("t", "j", "2", "o"),
                    ("u", "i", "3", "o"), ("u", "i", None, "o"), ("t", None, "2", "o"))
    entries = frame("ticket_id string, material_id string, price_scale_fam_name string",
                    ("i", "0" * 17 + "1", "F"), ("i", "0" * 17 + "1", "F"), ("j", "0" * 17 + "2", "F"),
                    ("j", None, "F"), (None, "0" * 17 + "3", "F"))
    out = C.resolve_price_scale(raw, summary, entries)
    # Input, tickets, offers and scales, each by the key it is joined on, and the distinct result.
    assert len(re.findall(r"Exchange hashpartitioning", _plan(out))) == 5
    found = sorted((r["material_id"] or "", r["scale_scenario_type"]) for r in out.collect())
    assert found == [("", "2"), (" ".rjust(18, "0"), "2"), ("0" * 17 + "1", "1"), ("0" * 17 + "1", "2"),
                     ("0" * 17 + "2", "2")]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
def test_family_quotations_are_made_distinct_on_few_columns(spark):
    f = frames(spark, SF_DIR)
    narrow = _family_quotation(f)
    assert narrow.schema == f.family_quotation.schema
    assert narrow.exceptAll(f.family_quotation).isEmpty() and f.family_quotation.exceptAll(narrow).isEmpty()
    plan = _plan(driver.queries()["expand_family_quotation"](spark, SF_DIR))
    dealt = re.findall(r"Exchange hashpartitioning\((.*?), \d+\), ", plan)
    assert dealt and max(len(re.split(r", (?![^(]*\))", keys)) for keys in dealt) <= 6


def test_pages_and_bodies_read_their_input_once(spark):
    rows = spark.range(0, 1000).select(
        F.lit("s").alias("source_system_code"), F.col("id").cast("string").alias("jsonObject"),
        (F.col("id") % 3).alias("recipient"), F.lit("o").alias("ticket_owner"))
    assert "Range" in _plan(rows)
    assert "Range" not in _plan(Y.region_payload(rows, ["s"], 10))
    assert "Range" not in _plan(Q.digest_by_recipient(rows, ["jsonObject"]))


def test_needs_of_both_horizons_read_consumption_and_plan_once(spark, tmp_path):
    import datetime as dt

    frames = {"consumption": "material_id string, plant_code string, material_type string,"
                             "requirement_date_for_the_component string,"
                             "sum_total_requirement_qty double",
              "plan": "agreement_naturalkey string, material_id string, plant_code string"}
    for name, schema in frames.items():
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
    read = {n: spark.read.parquet(str(tmp_path / n)) for n in frames}
    keys = ["material_id", "plant_code", "material_type"]
    needs = P.consumption_by_horizon(read["consumption"], keys, dt.date(2024, 1, 1))
    assert _scans(P._needs_per_agreement(read["plan"], needs)) == 2
