"""Raw extracts to published tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from lotcraft.operators import conform as C
from lotcraft.operators.planning import consumption_within_days, padded_overrides
from lotcraft.sources import load_csv_dir, publish

YEAR_DAYS = 365


@dataclass(frozen=True)
class TestRows:
    """What marks a test ticket: owners, vendor patterns and a family pattern."""

    __test__ = False  # not a test class, whatever its name

    owners: Sequence[str] = ()
    vendors: Sequence[str] = ()
    family: str = C.TEST_FAMILY


@dataclass(frozen=True)
class Extracts:
    """Names of the extract tables; each is a CSV file or folder of the same name."""

    # Names of the extract files.
    names: Mapping[str, str] = field(default_factory=lambda: {
        "trigger": "abc_trigger_summary_dim",
        "inprocess": "abc_supplier_input_inprocess_dim",
        "input": "abc_supplier_input_dim",
        "scale_summary": "abc_scale_summary_dim",
        "scale": "abc_scale_fact",
        "quotation_summary": "abc_quotation_summary_dim",
        "quotation": "abc_quotation_fact",
        "family_quotation": "abc_quotation_fam_fact",
        "override": "abc_fcst_override_fact",
    })


def conform_and_publish(
    raw: Mapping[str, DataFrame],
    consumption: DataFrame,
    previous_override: DataFrame,
    root: str,
    as_of: dt.date,
    test_rows: TestRows = TestRows(),
) -> dict[str, DataFrame]:
    """Publish every conformed table below `root` and return it as read back.

    Tables that others join to are published first, so that each extract is parsed once.
    `previous_override` is the override table of the run before; `root` must be a new folder,
    as this run's tables never replace what it reads.
    """
    owners, vendors, family = test_rows.owners, test_rows.vendors, test_rows.family
    out: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        path = f"{root.rstrip('/')}/{name}"
        publish(df, path, mode="error")
        out[name] = df.sparkSession.read.parquet(path)
        return out[name]

    trigger = keep("trigger", C.conform_trigger_summary(raw["trigger"], owners, vendors))
    scale_summary = keep("scale_summary", C.conform_scale_summary(raw["scale_summary"], owners))
    quotation_summary = keep(
        "quotation_summary",
        C.conform_quotation_summary(raw["quotation_summary"], owners, vendors),
    )
    entries = keep(
        "input", C.conform_supplier_input(raw["input"], trigger, owners, vendors, family)
    )
    keep("inprocess",
         C.conform_inprocess_input(raw["inprocess"], trigger, owners, vendors, family))
    keep("scale", C.resolve_price_scale(raw["scale"], scale_summary, entries, owners))
    per_family = keep("family_quotation", C.conform_quotation(
        raw["family_quotation"], quotation_summary, True, owners, vendors))
    year = consumption_within_days(consumption, ["plant_code", "material_id"], YEAR_DAYS, as_of)
    keep("quotation", C.expand_family_quotation(
        C.conform_quotation(raw["quotation"], quotation_summary, False, owners, vendors),
        per_family, quotation_summary, entries, trigger, year,
        padded_overrides(previous_override),
    ))
    keep("override", C.conform_forecast_override(raw["override"], trigger, owners, vendors))
    return out


def read_extracts(
    spark: SparkSession, directory: str, extracts: Extracts = Extracts(),
    broken_lines: bool = True,
) -> dict[str, DataFrame]:
    tables = load_csv_dir(spark, directory, broken_lines=broken_lines)
    return {role: tables[name] for role, name in extracts.names.items() if name in tables}
