from __future__ import annotations

import datetime as dt
import glob

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lotcraft.operators.payload import row_json
from lotcraft.plans.ingest import conform_and_publish
from lotcraft import schemas as S
from lotcraft.sources import (
    cut_lineage, export_csv_chunks, load_csv_dir, publish, read_pipe_csv, shared_folder,
    write_payload, write_snapshot,
)
from tests.conftest import values


def test_pipe_csv_with_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('a b|c\n"one ""quoted"" | pipe"|"two\nlines"\n007|\n')
    df = read_pipe_csv(spark, str(path))
    assert df.dtypes == [("a b", "string"), ("c", "string")]
    assert values(df) == [("007", None), ('one "quoted" | pipe', "two\nlines")]


def test_directory_of_extracts(spark, tmp_path):
    (tmp_path / "t.one.csv").write_text("a,b|n.(x)\nz|1.5\n")
    (tmp_path / "note.txt").write_text("ignored")
    tables = load_csv_dir(spark, str(tmp_path), {"t_one": {"nx": "decimal(10,2)"}})
    assert list(tables) == ["t_one"]
    assert tables["t_one"].dtypes == [("a_b", "string"), ("nx", "decimal(10,2)")]


def test_chunks_stay_within_the_row_limit(spark, tmp_path):
    export_csv_chunks(spark.range(950).coalesce(2), str(tmp_path / "out"), rows=100)
    files = glob.glob(str(tmp_path / "out" / "*.csv"))
    assert max(len(open(f).readlines()) for f in files) == 101
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 950


def test_partitioned_table_prunes_folders(spark, frame, tmp_path):
    df = frame("source_system_code string, v int", ("A", 1), ("B", 2))
    publish(df, str(tmp_path / "t"), partition_by=["source_system_code"])
    read = spark.read.parquet(str(tmp_path / "t")).filter("source_system_code = 'A'")
    assert values(read, "v") == [(1,)]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source_system_code" in plan


def test_few_folders_are_written_without_a_sort(spark, tmp_path):
    for folders in (3, 40):  # beyond the files held open the rest is sorted; nothing is lost
        path = str(tmp_path / str(folders))
        publish(spark.range(1000).selectExpr("id", f"id % {folders} AS k"), path, partition_by=["k"])
        assert spark.read.parquet(path).distinct().count() == 1000
        runs = spark._jsparkSession.sharedState().statusStore().executionsList()
        plans = [p for p in (runs.apply(i).physicalPlanDescription() for i in range(runs.size())) if path in p]
        assert plans and not any("Sort" in p for p in plans if "InsertInto" in p)


def test_snapshot_is_never_replaced(spark, tmp_path):
    path = write_snapshot(spark.range(3), str(tmp_path), "1")
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(AnalysisException):
        write_snapshot(spark.range(4), str(tmp_path), "1")


def test_payload_files_hold_one_object_per_line(spark, tmp_path):
    df = row_json(spark.range(25).coalesce(1), ["id"])
    write_payload(df, str(tmp_path / "p"), "jsonObject", 10)
    lengths = sorted(len(open(f).readlines()) for f in glob.glob(str(tmp_path / "p" / "part*")))
    assert lengths == [5, 10, 10]


def test_shared_folder_is_only_made_up_locally(spark):
    class Context:
        master, applicationId = "yarn", "x"

        def getConf(self):
            return self

        def get(self, name, default):
            return default

    class Session:
        sparkContext = conf = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())
    assert shared_folder(spark) == shared_folder(spark)

    class Named(Context):
        def get(self, name, default):
            return {"spark.checkpoint.dir": "/shared/folder/"}[name]

    Session.sparkContext = Session.conf = Named()
    assert shared_folder(Session()) == "/shared/folder"


def test_cut_lineage_reads_written_files(spark):
    df = cut_lineage(spark.range(5).selectExpr("id", "id * 2 AS twice"))
    assert df.count() == 5
    assert "FileScan parquet" in df._jdf.queryExecution().executedPlan().toString()


def test_ingest_publishes_every_table(spark, frame, tmp_path):
    def raw(names, **row):
        return frame(", ".join(f"`{n}` string" for n in names),
                     tuple(row.get(n) for n in names))

    trigger = [c for c in ("vendor_id", *S.TRIGGER_SUMMARY_TEXT, *S.TRIGGER_SUMMARY_TYPES,
                           "commercial_transparency_type")]
    key = {"vendor_id": "1", "plant_code": "2", "material_id": "3", "ticket_id": "t"}
    summary = {"ticket_id": "t", "supplier_input_ticket_id": "t", "ticket_owner": "o",
               "vendor_id": "1"}
    tables = {
        "trigger": raw(trigger, vendor_id="1", ticket_id="t", ticket_owner="o"),
        "inprocess": raw(["vendor_code", *S.INPROCESS_COLUMNS[1:]], vendor_code="1",
                         abc_mat_fam_new="f", **{k: v for k, v in key.items()
                                                 if k != "vendor_id"}),
        "input": raw(S.SUPPLIER_INPUT_COLUMNS, abc_mat_fam_new_msm="F", **key),
        "scale_summary": raw(S.SCALE_SUMMARY_COLUMNS, scale_scenario_type="1", **summary),
        "scale": raw(S.SCALE_FACT_COLUMNS, **key),
        "quotation_summary": raw(S.QUOTATION_SUMMARY_COLUMNS, quotation_scenario_type="2",
                                 **summary),
        "quotation": raw(S.quotation_columns(False), **key),
        "family_quotation": raw(S.quotation_columns(True), vendor_id="1", plant_code="2",
                                ticket_id="t", abc_mat_fam_new_msm="F"),
        "override": raw(S.FORECAST_OVERRIDE_COLUMNS, **key),
    }
    consumption = frame("plant_code string, material_id string,"
                        "requirement_date_for_the_component string,"
                        "sum_total_requirement_qty double",
                        ("0002", "0" * 17 + "3", "20240101", 12.345))
    previous = frame("vendor_id string, plant_code string, material_id string, ticket_id string,"
                     "qty_forecast_override double", ("9", "9", "9", "9", 1.0))
    out = conform_and_publish(tables, consumption, previous, str(tmp_path / "run"),
                              dt.date(2024, 1, 1))
    assert {name: df.count() for name, df in out.items()} == dict.fromkeys(out, 1)
    assert values(out["quotation"], "material_id", "qty_forecast_n12") == [("0" * 17 + "3", 12.35)]


def test_a_file_without_broken_lines_is_dealt_over_tasks(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text("a|b\n" + "".join(f'{i}|"x|{i}"\n' for i in range(50_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100KB")
    try:
        whole, split = (read_pipe_csv(spark, str(path), broken_lines=b) for b in (True, False))
        tasks = [df.select(F.spark_partition_id()).distinct().count() for df in (whole, split)]
        assert tasks[0] == 1 and tasks[1] > 4
        assert split.exceptAll(whole).count() == 0 and split.count() == 50_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
