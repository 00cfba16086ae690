"""Export templates joined from planning results and master data."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotcraft.functions import (
    attach_group_values,
    id_number,
    is_blank,
    one_row_per_group,
    parsed_number,
    region_code,
    unique_rows_only,
)
from lotcraft.operators.planning import PLANNED_TYPES, joined_set

# Change frequency in days when none is known.
PACKAGING_FREQUENCY = 180
OTHER_FREQUENCY = 365
PALLET_TYPES = ("Pallet", "pallet")
AGREED_COLUMNS = [
    "material_desc", "base_uom", "business_unit", "doc_curr_code", "price_unit_factor",
    "net_price_rate", "spend_pool_low_name", "business_unit_lkp_code",
]
TEMPLATE_KEYS = ["vendor_id", "material_id", "plant_code"]
PLACE = ["material_id", "plant_code", "purchase_vendor_id"]


def shelf_life(
    df: DataFrame,
    value: str = "calc_shelf_life",
    keys: Sequence[str] = ("material_id", "source_system_code", "material_type"),
    out: str = "material_shelf_life_months",
) -> DataFrame:
    """Shortest shelf life per key as text, '' when it is missing or zero."""
    shortest = F.min(value)
    return df.groupBy(*keys).agg(shortest.alias("_least")).select(
        *keys,
        F.when(is_blank("_least") | (parsed_number("_least", "double") == 0), F.lit(""))
        .otherwise(F.col("_least").cast("string"))
        .alias(out),
    )


def vendor_plant_change_frequency(freq: DataFrame, lead: DataFrame) -> DataFrame:
    """Average days between changes per plant and lead vendor.

    A single change, a negative or a missing average counts as a year.
    """
    leads = lead.filter(F.col("itm_rank") == 1).select(
        "plant_code", F.col("material_id").alias("iopt_initiative_pi_material_id"),
        F.col("purchase_vendor_id").alias("lead_vendor_id"),
    )
    days = F.col("change_frequency_avg_days").cast("double")
    unknown = F.col("change_frequency_times").cast("string") == "1"
    adjusted = F.when(unknown | (days < 0) | days.isNull(), F.lit(float(OTHER_FREQUENCY)))
    joined = freq.join(leads, ["plant_code", "iopt_initiative_pi_material_id"])
    return joined.groupBy("plant_code", "lead_vendor_id").agg(
        F.avg(adjusted.otherwise(days)).alias("vendor_plant_change_freq")
    )


def plant_region(plant: DataFrame, geo: DataFrame) -> DataFrame:
    """Plants with the region code of their country's area."""
    return plant.join(geo.select("country_code", "area"), "country_code", "left").select(
        "plant_code", "plant_name", region_code("area").alias("region_override")
    )


def distinct_plant_region(plant: DataFrame, geo: DataFrame) -> DataFrame:
    """Plants once per name and region, whatever the master data repeats."""
    areas = geo.select(
        "country_code", "region_name", "country_name", region_code("area").alias("region_override")
    ).distinct()
    return (
        plant.select("plant_code", "plant_name", "country_code").distinct()
        .join(areas, "country_code", "left")
        .select("plant_code", "plant_name", "region_override")
        .distinct()
    )


def active_agreements(
    agr: DataFrame, as_of: dt.date, types: Sequence[str] = PLANNED_TYPES
) -> DataFrame:
    """Source-list agreements of planned materials that end this month or later."""
    return agr.filter(
        (F.col("source_list_flag") == "Y")
        & (F.col("valid_end_date") >= as_of.strftime("%Y%m01"))
        & F.col("material_type").isin(*types)
    )


def agreements_once(agr: DataFrame) -> DataFrame:
    """Source-list agreements, those that differ in no template column once."""
    listed = agr.filter(F.col("source_list_flag") == "Y")
    return listed.select(
        "purchase_vendor_id", "material_id", "plant_code", *AGREED_COLUMNS
    ).distinct()


def latest_attribute(
    df: DataFrame, keys: Sequence[str], order: str, value: str, out: str | None = None
) -> DataFrame:
    """Per key the value in the row that ranks highest by `order`; ties take the largest value.

    An aggregation instead of an ordered window: each task sends one row per key. A missing
    value in the highest row stays missing.
    """
    top = F.max(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))
    return df.groupBy(*keys).agg(top["v"].alias(out or value))


def no_demand(forecast: str | Column, indicator: str | Column) -> Column:
    """Forecast that is missing, not a number or not positive, without an initiative."""
    column = F.col(forecast) if isinstance(forecast, str) else forecast
    named = F.col(indicator) if isinstance(indicator, str) else indicator
    wanted = F.coalesce(parsed_number(column, "float") > 0, F.lit(False))
    return ~wanted & (named.isNull() | (named == ""))


def _pair(vendor: str, material: str = "material_id") -> Column:
    """Vendor and material as numbers in one value, in which missing ones are equal."""
    return F.struct(id_number(vendor).alias("_vendor"), id_number(material).alias("_material")).alias("_pair")


def _listed(df: DataFrame, key: str, out: str) -> DataFrame:
    """One row per key with the other columns of its rows as a list."""
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.collect_list(F.struct(*others)).alias(out))


def supplier_template(
    fact: DataFrame,
    material: DataFrame,
    spend_pool: DataFrame,
    change_freq: DataFrame,
    agreements: DataFrame,
    supplier_input: DataFrame,
    plant_regions: DataFrame,
    shelf: DataFrame,
    production: DataFrame,
    business_units: DataFrame,
    known_plants: bool = False,
) -> DataFrame:
    """Supplier template: planning rows with master data, defaults filled, distinct.

    With `known_plants`, only rows of the plants in `plant_regions` stay, which
    `distinct_plant_region` gives once per name and region; otherwise the region may be missing.

    Rows without demand are dropped before the joins. The lookup sides are cut to the
    columns used and made distinct, as repeats could only inflate a distinct result; the
    stacking factor comes from one aggregation over the supplier input.

    What is known of a vendor and material, by number, is gathered first, with a short list of
    what differs by plant, system or spelling. The wide planning rows then cross the network
    once, to meet it, and the last distinct needs no exchange of its own.
    """
    demanded = fact.filter(~no_demand("qty_forecast_n12", "pipo_indicator"))
    base = demanded.select("*", _pair("purchase_vendor_id"))
    materials = material.select(
        id_number("material_number").alias("_material"), "material_desc",
        "base_unit_of_measure", F.col("material_group").alias("_group"),
    ).distinct()
    pools = spend_pool.select(
        F.col("spend_pool_lkp_code").alias("_group"), "spend_pool_high_name"
    ).distinct()
    lives = shelf.select(
        id_number("material_id").alias("_material"), "source_system_code", "material_id",
        F.col("material_shelf_life_months").alias("_shelf_life"),
    ).repartition("_material").distinct()
    described = (
        base.select("_pair").distinct().withColumn("_material", F.col("_pair._material"))
        .join(_listed(lives, "_material", "_lives"), "_material")
        .join(materials, "_material")
        .join(pools, "_group", "left")
        .drop("_material", "_group")
    )
    changes = change_freq.select(
        "plant_code", F.col("lead_vendor_id").alias("purchase_vendor_id"),
        F.col("vendor_plant_change_freq").alias("_frequency"),
    )
    changed = ["plant_code", "purchase_vendor_id"]
    frequency = (
        base.select(*changed, "_pair").repartition(*changed).distinct()
        .join(changes, changed).repartition("_pair")
    )
    lines = agreements.select(
        _pair("purchase_vendor_id"), *PLACE, F.col("plant_name").alias("_plant_name"),
        "purchase_doc_type_desc",
    ).repartition("_pair").distinct()
    stacking = latest_attribute(
        supplier_input.select(
            _pair("vendor_id"), "material_id", "plant_code",
            F.col("vendor_id").alias("purchase_vendor_id"),
            "ticket_id", parsed_number("pallet_stacking_factor", "int").alias("_stack"),
        ).repartition("_pair"),
        ["_pair", *PLACE], "ticket_id", "_stack",
    )
    produced = production.select(
        _pair("vendor_id"), "min_prod_quantity", "production_family"
    ).filter(F.col("_pair._vendor").isNotNull()).repartition("_pair").distinct()
    units = business_units.select(
        F.col("code").alias("business_unit_lkp_code"), F.col("category").alias("tdc_value")
    ).distinct()
    regions = plant_regions.select("plant_code", "region_override").distinct()

    def own(entries: str, keys: Sequence[str]) -> Column:
        """The entries of a list that name the row's own values of the keys."""
        return F.filter(entries, lambda e: reduce(and_, [e[k] == F.col(k) for k in keys]))

    joined = (
        base.join(described, "_pair")
        .join(_listed(lines, "_pair", "_lines"), "_pair", "left")
        .join(_listed(stacking, "_pair", "_stacks"), "_pair", "left")
        .join(_listed(frequency, "_pair", "_changes"), "_pair", "left")
        .join(produced, "_pair", "left")
        .withColumn("_life", F.explode(own("_lives", ["source_system_code", "material_id"])))
        .withColumn("_line", F.explode_outer(own("_lines", PLACE)))
        .withColumn("_change", F.explode_outer(own("_changes", changed)))
        .withColumn("pallet_stacking_factor", F.get(own("_stacks", PLACE), F.lit(0))["_stack"])
        .join(regions, "plant_code", "inner" if known_plants else "left")
        .join(units, "business_unit_lkp_code", "left")
    )
    default_frequency = F.when(
        F.col("spend_pool_high_name") == "PACKAGING", F.lit(float(PACKAGING_FREQUENCY))
    ).otherwise(F.lit(float(OTHER_FREQUENCY)))
    whole = joined.select(
        "_pair",
        "material_desc",
        F.concat("plant_code", F.lit(": "), "_line._plant_name").alias("plant_code"),
        F.col("plant_code").alias("only_plant_code"),
        "base_unit_of_measure",
        "business_unit",
        F.col("region_override").alias("region"),
        F.col("mm_minimum_lot_size").alias("mm_min_lot_size"),
        F.coalesce(F.col("min_prod_qty").cast("string"), F.col("min_prod_quantity").cast("string"))
        .alias("min_prod_qty"),
        F.coalesce("production_family", "abc_mat_fam_name").alias("abc_mat_fam_name"),
        "restriction_min_prod_qty",
        "restriction_max_prod_qty",
        "material_per_pallet_qty",
        F.col("_life._shelf_life").alias("material_shelf_life_months"),
        "spend_pool_low_name",
        "business_unit_lkp_code",
        "tdc_value",
        "pipo_indicator",
        "material_phase_out_phase_in",
        F.col("iopt_initiative_name").alias("initiative_name"),
        parsed_number("prod_rounding_value", "int").alias("prod_rounding_value"),
        F.round(parsed_number("setup_cost_usd", "double"), 2).alias("setup_cost_usd"),
        "pallet_stacking_factor",
        F.coalesce("_change._frequency", default_frequency).alias("vendor_plant_change_freq"),
        "_line.purchase_doc_type_desc",
    ).distinct()
    return whole.select(
        F.col("_pair._vendor").alias("vendor_id"), F.col("_pair._material").alias("material_id"),
        *whole.columns[1:],
    )


def one_row_per_key(df: DataFrame, keys: Sequence[str] = tuple(TEMPLATE_KEYS)) -> DataFrame:
    """One row per key, always the same one."""
    return one_row_per_group(df, list(keys))


def forecast_template(
    horizons: DataFrame,
    plant: DataFrame,
    agreements: DataFrame,
    fact: DataFrame,
    business_units: DataFrame,
) -> DataFrame:
    """Forecast template: the horizons of each key with plant, agreement and initiative.

    `agreements` comes from `agreements_once` or `active_agreements`; a key is repeated for
    every agreement row it matches.
    """
    agreed = agreements.select(
        "plant_code", id_number("material_id").alias("_material"),
        id_number("purchase_vendor_id").alias("_vendor"), *AGREED_COLUMNS,
    )
    planned = fact.select(
        "purchase_vendor_id", "plant_code", "material_id", "pipo_indicator",
        "material_phase_out_phase_in", "iopt_initiative_name",
        F.col("business_unit_lkp_code").alias("_unit_code"),
    )
    units = business_units.select(
        F.col("code").alias("_unit_code"), F.col("category").alias("tdc_value")
    )
    plants = plant.select("plant_code", "plant_name", "prev_region_name",
                          F.col("plant_code").alias("only_plant_code"))
    keyed = horizons.select("*", id_number("material_id").alias("_material"),
                            id_number("purchase_vendor_id").alias("_vendor"))
    joined = (
        keyed.join(planned, ["purchase_vendor_id", "plant_code", "material_id"], "left")
        .filter(~no_demand("qty_forecast_n1y", "pipo_indicator"))
        .join(plants, "plant_code", "left")
        .join(agreed.withColumn("_agreed_vendor", F.col("_vendor")),
              ["plant_code", "_material", "_vendor"], "left")
        .join(units, "_unit_code", "left")
    )
    return joined.select(
        F.col("purchase_vendor_id").alias("vendor_id"),
        F.col("_agreed_vendor").alias("purchase_vendor_id"),
        F.concat("only_plant_code", F.lit(": "), "plant_name").alias("plant_code"),
        "plant_name",
        F.col("_material").alias("material_id"),
        "material_desc",
        F.coalesce("base_uom", F.lit("")).alias("base_unit_of_measure"),
        F.coalesce("business_unit", F.lit("")).alias("business_unit"),
        "qty_forecast_n1y",
        "only_plant_code",
        F.col("prev_region_name").alias("region"),
        "qty_forecast_n6m",
        "qty_forecast_n6m_annualized",
        "qty_forecast_n3m",
        "qty_forecast_n3m_annualized",
        "doc_curr_code",
        F.col("price_unit_factor").try_cast("decimal(10,2)").alias("price_unit_factor"),
        F.col("net_price_rate").try_cast("decimal(10,2)").alias("net_price_rate"),
        "spend_pool_low_name",
        "business_unit_lkp_code",
        "tdc_value",
        "pipo_indicator",
        "material_phase_out_phase_in",
        "iopt_initiative_name",
    )


def scale_template(
    scale: DataFrame, summary: DataFrame, plant: DataFrame, agr: DataFrame, level: str = "1"
) -> DataFrame:
    """Price scales of tickets on one level: '1' per material, '2' per family."""
    tickets = summary.filter(F.col("scale_scenario_type") == level).select(
        "ticket_id", F.col("scale_scenario_type").alias("_level")
    )
    plants = plant.select("plant_code", "plant_name", "prev_region_name",
                          F.col("plant_code").alias("only_plant_code"))
    agreed = agr.select(
        "plant_code", id_number("material_id").alias("_material"),
        id_number("purchase_vendor_id").alias("_vendor"), "business_unit",
    )
    item = {"1": F.col("_material").alias("material_id"), "2": F.col("scale_fam")}[level]
    joined = (
        scale.select("*", id_number("material_id").alias("_material"),
                     id_number("vendor_id").alias("_vendor"))
        .join(tickets, "ticket_id")
        .join(plants, "plant_code", "left")
        .join(agreed, ["plant_code", "_material", "_vendor"], "left")
    )
    return joined.select(
        F.col("_vendor").alias("vendor_id"),
        F.concat("only_plant_code", F.lit(": "), "plant_name").alias("plant_code"),
        item,
        "scale_uom",
        "mpq_scale_qty",
        "doc_curr_code",
        "scale_price",
        "price_unit_factor",
        F.coalesce("business_unit", F.lit("")).alias("business_unit"),
        "only_plant_code",
        F.col("prev_region_name").alias("region"),
        F.col("_level").alias("scale_scenario_type"),
    )


def latest_valid_price_scale(
    agr: DataFrame, ps: DataFrame, pv: DataFrame, systems: Sequence[str]
) -> DataFrame:
    """Scales of the condition record that is valid longest, per listed agreement line."""
    line = ["source_system_code", "purchase_doc_num", "purchase_doc_line_num"]
    validity = pv.filter(F.col("source_system_code").isin(*systems)).select(
        *line, "cond_rec_num", "valid_end_date"
    )
    top = attach_group_values(validity, line, F.max("valid_end_date").alias("_top"))
    records = (
        top.filter(F.col("valid_end_date") == F.col("_top"))
        .select(*line, id_number("cond_rec_num").alias("_record"), "valid_end_date")
        .distinct()
    )
    scales = (
        ps.filter((F.col("deletion_ind") != "X") & F.col("source_system_code").isin(*systems))
        .withColumn("_record", id_number("cond_rec_num"))
        .join(records, [*line, "_record", "valid_end_date"])
        .select(*line, "scale_quantity", "rate", "valid_start_date")
        .distinct()
    )
    listed = agr.filter(
        F.col("source_system_code").isin(*systems) & (F.col("source_list_flag") == "Y")
    )
    return listed.join(scales, line).select(
        id_number("purchase_vendor_id").alias("vendor_id"),
        F.concat("plant_code", F.lit(": "), "plant_name").alias("plant_code"),
        id_number("material_id").alias("material_id"),
        F.col("order_uom").alias("scale_uom"),
        F.col("scale_quantity").alias("mpq_scale_qty"),
        "doc_curr_code",
        F.col("rate").try_cast("decimal(10,2)").alias("scale_price"),
        "price_unit_factor",
        "valid_start_date",
        F.col("plant_code").alias("only_plant_code"),
        *line,
    ).distinct()


def drop_ambiguous(
    df: DataFrame, keys: Sequence[str] = ("vendor_id", "material_id", "plant_code", "mpq_scale_qty")
) -> DataFrame:
    """Without the rows of any repeated key; rows with a null in the key stay."""
    return unique_rows_only(df, list(keys))


def agreement_template(
    ppf: DataFrame, vendor: DataFrame, material: DataFrame, agr: DataFrame
) -> DataFrame:
    """Vendor, material and plant combinations with their units and regions, and tickets.

    `vendor` lists the display ids that may appear.
    """
    known = vendor.select(F.col("display_vendor_id").cast("bigint").alias("_vendor")).distinct()
    materials = material.select(
        id_number("material_number").alias("_material"), "base_unit_of_measure"
    ).distinct()
    rows = ppf.select(
        id_number("purchase_vendor_id").alias("_vendor"), "vendor_name",
        id_number("material_id").alias("_material"), "material_desc",
        F.concat("plant_code", F.lit(" : "), "plant_name").alias("plant"), "plant_code",
        "business_unit", "plant_region_override", "purchase_vendor_id", "material_id",
    ).join(known, "_vendor", "left_semi")
    keys = ["purchase_vendor_id", "_vendor", "vendor_name", "material_id", "_material",
            "material_desc", "plant", "plant_code"]
    grouped = rows.groupBy(*keys).agg(
        joined_set("business_unit", "|").alias("business_unit"),
        joined_set("plant_region_override", "|").alias("region"),
    )
    tickets = agr.select(
        id_number("vendor_id").alias("_vendor"), id_number("material_id").alias("_material"),
        "ticket_custom_id",
    )
    return (
        grouped.join(materials, "_material", "left")
        .join(tickets, ["_vendor", "_material"], "left")
        .select(
            F.col("_vendor").alias("purchase_vendor_id"), "vendor_name",
            F.col("_material").alias("material_id"), "material_desc", "business_unit", "region",
            "plant", F.coalesce("base_unit_of_measure", F.lit("n/a")).alias("base_unit_of_measure"),
            "plant_code", "ticket_custom_id",
        )
    )


def _year_ahead(cons: DataFrame, as_of: dt.date) -> DataFrame:
    """Requirement per material and plant from this month to the same month next year."""
    month = F.substring("requirement_date_for_the_component", 1, 6)
    first, last = as_of.strftime("%Y%m"), f"{as_of.year + 1:04d}{as_of.month:02d}"
    return (
        cons.filter((F.col("requirement_date_for_the_component") >= first) & (month <= last))
        .groupBy("material_id", "plant_code")
        .agg(F.sum("sum_total_requirement_qty").alias("_required"))
    )


def legacy_min_lot_template(
    plan: DataFrame, material: DataFrame, cons: DataFrame, shelf: DataFrame, as_of: dt.date
) -> DataFrame:
    """Smallest lot per vendor and material with the year's requirement of its plants.

    The lot minimum comes back to the planning rows that hold it; the shelf life matches on
    the first three characters of one system code and the fifth to seventh of the other.
    """
    grouping = ["purchase_vendor_id", "material_id", "material_desc"]
    least = plan.groupBy(*grouping).agg(F.min("mm_minimum_lot_size").alias("mm_min_lot_size"))
    holders = plan.select(
        "purchase_vendor_id", "material_id", F.col("mm_minimum_lot_size").alias("mm_min_lot_size"),
        "source_system_code", "plant_code",
    )
    held = least.join(
        material.select(F.col("material_number").alias("material_id"), "base_unit_of_measure"),
        "material_id",
    ).join(holders, ["purchase_vendor_id", "material_id", "mm_min_lot_size"])
    lives = shelf.select(
        "material_id", F.substring("source_system_code", 5, 3).alias("_system"),
        "material_shelf_life_months",
    )
    required = held.withColumn("_system", F.substring("source_system_code", 1, 3)).join(
        _year_ahead(cons, as_of), ["material_id", "plant_code"]
    )
    return (
        required.join(lives, ["material_id", "_system"], "left")
        .groupBy(F.col("purchase_vendor_id").alias("vendor_id"), "material_id", "material_desc",
                 "mm_min_lot_size", "material_shelf_life_months", "base_unit_of_measure")
        .agg(F.sum("_required").alias("qty_forecast_n12"))
        .select(
            "vendor_id", "material_id", "material_desc",
            *[F.lit("").alias(c) for c in ("material_id_phase_in", "date_phase_in")],
            "qty_forecast_n12", "base_unit_of_measure", "mm_min_lot_size",
            *[F.lit("").alias(c) for c in (
                "min_prod_qty", "abc_mat_fam_name", "restriction_min_prod_qty",
                "restriction_max_prod_qty", "material_per_pallet_qty")],
            "material_shelf_life_months",
        )
    )


def pallet_and_phase_in(base: DataFrame, storage: DataFrame, init: DataFrame) -> DataFrame:
    """Base rows with the pallet quantity, the material that phases them out, and its date.

    The pallet quantity is that of a pallet storage unit, else ''. Business units of merged
    rows become one sorted text; quantities are summed. Requirements are summed per base row,
    storage unit and initiative, as each combination is a row of its own.
    """
    stored = storage.select(
        id_number("vendor_id").alias("_vendor"), id_number("material_id").alias("_material"),
        "storage_unit_type", F.col("storage_unit_quantity").cast("string").alias("_quantity"),
    )
    phased = init.select(
        id_number("iopt_initiative_po_material_id").alias("_material"), "plant_code",
        "iopt_initiative_pi_material_id",
        F.col("iopt_initiative_sop_soq").try_cast("date").alias("iopt_initiative_sop_soq"),
    )
    merged = [c for c in base.columns if c not in ("business_unit", "qty_forecast_n12")]
    # Lines are merged before the lookups can repeat them.
    lines = base.groupBy(*merged).agg(
        joined_set("business_unit", "|").alias("business_unit"),
        F.sum("qty_forecast_n12").alias("qty_forecast_n12"),
    )
    pallet = F.when(F.col("storage_unit_type").isin(*PALLET_TYPES), F.col("_quantity")).otherwise(
        F.lit("")
    )
    return (
        lines.select("*", id_number("vendor_id").alias("_vendor"),
                     id_number("material_id").alias("_material"))
        .join(stored, ["_vendor", "_material"], "left")
        .join(phased, ["_material", "plant_code"], "left")
        .withColumn("material_per_pallet_qty", pallet)
        .groupBy(*merged, "business_unit", "storage_unit_type", "_quantity",
                 "material_per_pallet_qty", "iopt_initiative_pi_material_id",
                 "iopt_initiative_sop_soq")
        .agg(F.sum("qty_forecast_n12").alias("qty_forecast_n12"))
        .drop("storage_unit_type", "_quantity")
    )
