"""Agreements and ticket input to classes, optimal quantities and payload rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotcraft import schemas as S
from lotcraft.functions import (
    attach_group_values,
    attach_lookup,
    equals_ignoring_case,
    group_values,
    left_padded,
)
from lotcraft.functions.columns import MATERIAL_WIDTH, PLANT_WIDTH, VENDOR_WIDTH
from lotcraft.operators import classify as K
from lotcraft.operators import mpq as M
from lotcraft.operators import payload as Y
from lotcraft.operators import planning as P
from lotcraft.session import joined_where_dealt
from lotcraft.sources import cut_lineage

LINE_KEYS = ["vendor_id", "material_id", "plant_code"]
INITIATIVE_TEXTS = [
    "iopt_initiative_name", "iopt_initiative_pi_material_id", "material_phase_out_phase_in",
]
BLANKED = ["abc_mat_fam_name", "abc_mat_fam_new_msm", "supplier_storage_flag", "pipo_indicator",
           *INITIATIVE_TEXTS]


def _padded_input(entries: DataFrame) -> DataFrame:
    widths = {"vendor_id": VENDOR_WIDTH, "material_id": MATERIAL_WIDTH, "plant_code": PLANT_WIDTH}
    return entries.withColumns({c: left_padded(c, w) for c, w in widths.items()})


def _padded_storage(storage: DataFrame) -> DataFrame:
    return storage.withColumns({
        "vendor_id": left_padded("vendor_id", VENDOR_WIDTH),
        "material_id": left_padded("material_id", MATERIAL_WIDTH),
    })


def _with_line_facts(
    lines: DataFrame, tables: Mapping[str, DataFrame], entries: DataFrame, tickets: DataFrame, side: str
) -> DataFrame:
    """Lines with what their vendor, plant, material and ticket say of them.

    The storage unit, the material's text, the joined initiatives and the details of the tickets
    that `entries` name come to the material's lines on narrow rows. Initiatives are joined per
    material and plant, before any line could be repeated for each of them.
    """
    units = P.storage_unit_per_key(
        P.dealt_by_material(_padded_storage(tables["storage"])), ["vendor_id", "_material"])
    texts = P.dealt_by_material(tables["material"].select(
        F.col("material_number").alias("material_id"), "material_desc")).distinct()

    place = ["plant_code", "material_id"]
    pairs = P.initiatives_per_pair(tables["initiative"])
    places = pairs.select("plant_code", F.explode(F.array(
        "iopt_initiative_po_material_id", "iopt_initiative_pi_material_id")).alias("material_id"))
    phased = P.phase_in_out(places.distinct(), pairs, side)
    initiatives = P.collapse_lines(phased, [*place, "pipo_indicator"], INITIATIVE_TEXTS)

    asked = P.keyed_by_material(entries.select("material_id", "ticket_id")).repartition("ticket_id")
    details = P.add_ticket_details(asked.distinct(), tickets, how="inner")
    return (
        lines.join(P.dealt_by_material(initiatives), ["_material", "plant_code"], "left")
        .join(texts, "_material", "left")
        .join(units.withColumnRenamed("vendor_id", "purchase_vendor_id"),
              ["_material", "purchase_vendor_id"], "left")
        .join(details.repartition("_material"), ["_material", "ticket_id"], "left")
    )


def price_lines(tables: Mapping[str, DataFrame], as_of: dt.date, side: str = "pi") -> DataFrame:
    """One priced line per agreement grain: enriched, with initiatives, prices averaged; written.

    Consumption is read once for both horizons. All tables are dealt by material, and so the wide
    lines cross the network once; equal ones merge and are averaged where they are. The prices'
    cases need the agreements' keys only, which are written with their plan. As a key's input has
    one ticket, its highest, the lines of the key have no other.
    """
    needs = P.consumption_by_horizon(
        tables["consumption"], ["material_id", "plant_code", "material_type"], as_of)
    open_tickets = tables["trigger"].filter(F.col("commercial_transparency_flag") != "yes")
    priced = [*P.PRICE_KEYS, "price_unit_factor", "doc_curr_code"]
    measured = cut_lineage(P.agreement_needs(
        tables["agreement"], tables["plan"], needs, ["agreement_naturalkey", *priced]), "measured")
    entries = _padded_input(tables["input"])
    enriched = P.enrich_by_material(
        tables["agreement"], measured, tables["sync"], entries, tables["override"], open_tickets,
        None, tables["plant"], tables["finance"], latest=True)
    merged = (
        _with_line_facts(enriched, tables, entries, open_tickets, side)
        .withColumn("material_per_pallet_qty",
                    F.coalesce("storage_unit_quantity", "material_per_pallet_qty"))
        .drop("storage_unit_quantity")
        .distinct()
        .withColumnsRenamed(
            {"net_price_rate": "price_purch_rate", "price_purch_usd": "price_purch_rate_usd"})
    )
    keys = ["_material", "purchase_vendor_id", "plant_code"]
    harmonised = P.harmonise_price_lines(
        Y.nulls_to_blank(merged, BLANKED), keys, combos=P.dealt_by_material(measured.select(*priced)))
    measures = {*P.PRICE_MEASURES, "supplier_input_repeats", "qty_consumption_per_day",
                "usage_uom", "weight", "cov_usage", "inventory", "sync"}
    grain = [c for c in harmonised.columns if c not in measures]
    averaged = P.average_prices(harmonised, grain)
    lines = averaged.select(
        "purchase_vendor_id", "plant_code", F.col("_material.material_id").alias("material_id"),
        *[c for c in averaged.columns if c not in keys])
    with joined_where_dealt(lines.sparkSession):
        return cut_lineage(lines, "lines")


def annual_runs_fact(lines: DataFrame) -> DataFrame:
    """Spend, class and current runs of priced lines.

    `lines` should be a written table. What its ticket and families say of a line is settled
    on one row per ticket and both families, and reaches the lines in one join.
    """
    ticket, current, future = "ticket_custom_id", "abc_mat_fam_name", "abc_mat_fam_new_msm"
    keys = ["ticket_id", ticket, current, future]
    priced = lines.withColumn("spend_material_current", K.spend())
    sums = cut_lineage(group_values(
        priced, keys, F.sum("spend_material_current").alias("_spend"),
        F.sum("qty_forecast_n12").alias("_quantity")), "families")
    classes = K.abc_classify(K.spend_and_share(sums, amount="_spend").select(
        ticket, future, "percentage"))
    spent = group_values(sums, [ticket, current], F.sum("_spend").alias("total_family_spend"))
    forecast = group_values(sums, ["ticket_id", current], F.sum("_quantity").alias("_family"))
    attached = attach_lookup(attach_lookup(sums, spent, [ticket, current]), forecast, ["ticket_id", current])
    classed = cut_lineage(K.attach_classes(attached, classes), "classed")
    # Partial sums of a ticket and class add up to the class's own.
    facts = attach_group_values(classed, [ticket], *K.segment_sums("abc_segment", "_quantity"))
    marked = K.family_indicators(
        attach_lookup(priced, facts.drop("_spend", "_quantity"), keys))
    alone = equals_ignoring_case("current_prod_fam_ind", "no")
    forecasted = marked.withColumn(
        "annual_fcst_cons_current",
        F.when(alone, F.col("qty_forecast_n12")).otherwise(F.col("_family"))).drop("_family")
    weight = K.segment_weight("abc_segment", "current_annual_runs", "qty_forecast_n12")
    return K.annual_runs(forecasted).withColumn("current_annual_runs_weighted", F.round(weight, 1))


def optimal_fact(fact: DataFrame, storage_flags: DataFrame) -> DataFrame:
    """The classified lines with the optimal quantity and the runs it leads to."""
    spent = cut_lineage(M.cumulative_family_share(M.family_spend(fact)), "spent")
    prepared = cut_lineage(M.prepare_scenarios(fact, storage_flags), "prepared")
    best = cut_lineage(M.best_quantities(prepared), "best")
    return M.optimal_weighted_runs(M.attach_optimal_mpq(spent, best))


def payload_fact(fact: DataFrame, run_time: dt.datetime) -> DataFrame:
    """All values as text without nulls, and each row as a JSON object."""
    named = fact.withColumnsRenamed({
        "opt_annual_runs_weighted": "annual_run_segment_weighted_setup_cost",
        "current_annual_runs_weighted": "annual_run_segment_weighted",
    }).withColumn("timestamp", F.lit(run_time.isoformat(sep=" ")))
    blanked = Y.nulls_to_blank(named)
    missing = [c for c in S.PAYLOAD_COLUMNS if c not in blanked.columns]
    if missing:
        raise ValueError(f"the payload is positional and lacks {', '.join(missing)}")
    return Y.row_json(blanked, S.PAYLOAD_COLUMNS)


def run(
    tables: Mapping[str, DataFrame],
    root: str,
    as_of: dt.date,
    run_time: dt.datetime,
    side: str = "pi",
) -> DataFrame:
    """Publish the annual-runs table and the payload table below `root`; return the latter."""
    spark = tables["agreement"].sparkSession
    lines = price_lines(tables, as_of, side)
    runs_path, payload_path = f"{root}/annual_runs_fact", f"{root}/input_fact"
    system = ["source_system_code"]
    annual_runs_fact(lines).write.mode("error").partitionBy(*system).parquet(runs_path)
    fact = spark.read.parquet(runs_path)
    best = optimal_fact(fact, tables["trigger"].select(
        "ticket_id", "current_supplier_storage_flag").distinct())
    payload_fact(best, run_time).write.mode("error").partitionBy(*system).parquet(payload_path)
    return spark.read.parquet(payload_path)
