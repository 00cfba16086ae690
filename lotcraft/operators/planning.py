"""Forecast horizons, agreement enrichment and price lines."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotcraft.functions import (
    equals_ignoring_case,
    latest_in_group,
    left_padded,
    settled_round,
    strip_leading_zeros,
)
from lotcraft.functions.columns import (
    MATERIAL_WIDTH,
    PLANT_WIDTH,
    TICKET_WIDTH,
    VENDOR_WIDTH,
)
from lotcraft.sources.staging import cut_lineage

REQUIREMENT_DATE = "requirement_date_for_the_component"
REQUIREMENT_QTY = "sum_total_requirement_qty"
PLANNED_TYPES = ("ROH", "HALB")
PRICE_KEYS = ["purchase_vendor_id", "plant_code", "material_id"]
# months ahead, factor that scales the horizon to a year
HORIZONS = ((12, 1), (6, 2), (3, 4))
QUARTER_DAYS = 91
DAY_HORIZONS = {"n13": QUARTER_DAYS, "n12m": 365}

AGREEMENT_COLUMNS = [
    "agreement_naturalkey", "source_system_code", "purchase_vendor_id", "plant_code",
    "material_id", "price_unit_factor", "doc_curr_code", "net_price_rate", "price_purch_usd",
    "spend_pool_lkp_code", "spend_pool_group", "spend_pool_medium_name",
    "spend_pool_low_name", "business_unit_lkp_code", "sector_business_unit", "business_unit",
]

PRICE_MEASURES = (
    "price_purch_rate",
    "price_purch_rate_usd",
    "mm_minimum_lot_size",
    "mm_minimum_lot_size_dfc",
    "avg_batch_consumption_qty",
)


def _year_month(day: dt.date, months: int = 0) -> str:
    """yyyyMM of the calendar month `months` after the one of `day`."""
    years, month = divmod(day.month - 1 + months, 12)
    return f"{day.year + years:04d}{month + 1:02d}"


def _day_after(day: dt.date, days: int) -> str:
    return (day + dt.timedelta(days=days)).strftime("%Y%m%d")


def consumption_within_days(
    cons: DataFrame,
    keys: Sequence[str],
    days: int,
    as_of: dt.date,
    out: str = "total_requirement_qty",
) -> DataFrame:
    """Requirement per key up to `days` ahead; what is overdue counts too.

    The bound is a literal, so it reaches the parquet scan.
    """
    return (
        cons.filter(F.col(REQUIREMENT_DATE) <= _day_after(as_of, days))
        .groupBy(*keys)
        .agg(F.sum(REQUIREMENT_QTY).alias(out))
    )


def consumption_by_horizon(
    cons: DataFrame,
    keys: Sequence[str],
    as_of: dt.date,
    horizons: Mapping[str, int] = DAY_HORIZONS,
) -> DataFrame:
    """Requirement per key within each named number of days, from one pass over the data.

    `rows_<name>` counts the rows behind `qty_<name>`: a key without any has no requirement,
    which a sum of nulls alone would not tell.
    """
    values = []
    for name, days in horizons.items():
        within = F.col(REQUIREMENT_DATE) <= _day_after(as_of, days)
        values += [F.count(F.when(within, F.lit(1))).alias(f"rows_{name}"),
                   F.sum(F.when(within, F.col(REQUIREMENT_QTY))).alias(f"qty_{name}")]
    return (
        cons.filter(F.col(REQUIREMENT_DATE) <= _day_after(as_of, max(horizons.values())))
        .groupBy(*keys)
        .agg(*values)
    )


def consumption_month_horizons(
    cons: DataFrame,
    as_of: dt.date,
    keys: Sequence[str] = ("purchase_vendor_id", "plant_code", "material_id"),
    types: Sequence[str] = PLANNED_TYPES,
) -> DataFrame:
    """Requirement of the next 12, 6 and 3 months, the shorter ones also as a year.

    Months count whole, this one and the last included. Only the 12-month sum is limited
    to planned material types, and keys without such rows are left out. One pass over the
    data serves the three horizons.
    """
    month = F.substring(REQUIREMENT_DATE, 1, 6)
    first = _year_month(as_of)
    qty = F.col(REQUIREMENT_QTY)
    planned = F.col("material_type").isin(*types)

    def within(months: int) -> Column:
        return month.between(first, _year_month(as_of, months))

    longest = HORIZONS[0][0]
    values = [
        F.count(F.when(planned, F.lit(1))).alias("_planned_rows"),
        F.sum(F.when(planned, qty)).alias("qty_forecast_n1y"),
    ]
    for months, factor in HORIZONS[1:]:
        total = F.sum(F.when(within(months), qty))
        values += [
            total.alias(f"qty_forecast_n{months}m"),
            (total * factor).alias(f"qty_forecast_n{months}m_annualized"),
        ]
    last = _year_month(as_of, longest)
    return (
        cons.filter((F.col(REQUIREMENT_DATE) >= first) & (month <= last))
        .groupBy(*keys)
        .agg(*values)
        .filter(F.col("_planned_rows") > 0)
        .drop("_planned_rows")
    )


def daily_consumption(total: str | Column, days: int = QUARTER_DAYS) -> Column:
    column = F.col(total) if isinstance(total, str) else total
    return column.cast("double") / F.lit(float(days))


def cover_days(quantity: str | Column, per_day: str | Column, places: int = 2) -> Column:
    """Days of forward cover: quantity over daily consumption, null when there is none."""
    quantity = F.col(quantity) if isinstance(quantity, str) else quantity
    per_day = F.col(per_day) if isinstance(per_day, str) else per_day
    return settled_round(F.try_divide(quantity.cast("double"), per_day.cast("double")), places)


def days_forward_cover(
    df: DataFrame,
    consumption_91d: str = "qty_consumption_n13",
    lot_size: str = "mm_minimum_lot_size",
    mpq: str = "min_prod_qty",
) -> DataFrame:
    """Daily consumption and the cover of the lot size and of the production quantity."""
    daily = df.withColumn("qty_consumption_per_day", daily_consumption(consumption_91d))
    return daily.withColumns(
        {
            f"{lot_size}_dfc": cover_days(lot_size, "qty_consumption_per_day"),
            f"{mpq}_dfc": cover_days(mpq, "qty_consumption_per_day"),
        }
    )


def latest_by_max_join(
    df: DataFrame, keys: Sequence[str], ticket: str = "ticket_id", dealt: bool = False
) -> DataFrame:
    """Rows of each key's highest ticket, ties kept; rows without key or ticket go.

    Rows that are `dealt` by one of the keys stay where they are.
    """
    if dealt:
        top = df.groupBy(*keys).agg(F.max(ticket).alias(ticket))
        return df.join(top, [*keys, ticket]).select(*df.columns)
    return latest_in_group(df, keys, ticket, null_order=False)


def latest_by_rank(df: DataFrame, keys: Sequence[str], ticket: str = "ticket_id") -> DataFrame:
    """Rows that rank first by ticket; a key that never has a ticket keeps its rows."""
    return latest_in_group(df, keys, ticket, null_order=True)


def storage_unit_per_key(
    df: DataFrame, keys: Sequence[str] = ("vendor_id", "material_id"),
    quantity: str = "storage_unit_quantity",
) -> DataFrame:
    """Largest storage unit per key."""
    return df.groupBy(*keys).agg(F.max(quantity).alias(quantity))


def forecast_choice(
    flag: str | Column, override: str | Column, forecast: str | Column, need_value: bool = True
) -> Column:
    """Override when the ticket allows one, else the computed forecast.

    With `need_value`, a missing override falls back to the forecast too.
    """
    column = lambda c: F.col(c) if isinstance(c, str) else c
    chosen = equals_ignoring_case(flag, "yes")
    if need_value:
        chosen = chosen & column(override).isNotNull()
    return F.when(chosen, column(override).cast("double")).otherwise(
        column(forecast).cast("double")
    )


def resolve_forecast(
    df: DataFrame,
    flag: str = "forecast_override_flag",
    override: str = "qty_forecast_override",
    forecast: str = "total_requirement_qty",
    out: str = "qty_forecast_n12",
    need_value: bool = True,
) -> DataFrame:
    return df.withColumn(out, forecast_choice(flag, override, forecast, need_value))


def drop_duplicated_tickets(df: DataFrame, repeats: str = "supplier_input_repeats") -> DataFrame:
    """Rows whose key was given once; rows without input stay."""
    return df.filter(F.col(repeats).isNull() | (F.col(repeats) == 1))


def _needs_per_agreement(plan: DataFrame, needs: DataFrame, lots: bool = False) -> DataFrame:
    """The sums of both horizons per agreement, as one short list each.

    A list has an entry per place and material type with consumption in that horizon. Equal
    plan rows are counted first and multiply the sums, as joining each of them would. With
    `lots`, every agreement of the plan has a row and `_lots`, its different lots with the number
    of plan rows of each; plan rows then cross the network with their lots, to their place and
    to their agreement.
    """
    place = ["material_id", "plant_code"]
    lot = ["mm_minimum_lot_size"] if lots else []

    def entries(name: str) -> Column:
        found = F.col(f"rows_{name}") > 0
        return F.collect_list(F.when(found, F.struct(F.col(f"qty_{name}").alias("qty"))))

    per_place = needs.groupBy(*place).agg(*[entries(n).alias(f"_{n}") for n in DAY_HORIZONS])
    # Dealt by place, rows are counted and meet the place's sums where they are.
    counted = (
        plan.filter(F.col("agreement_naturalkey").isNotNull())
        .select("agreement_naturalkey", *place, *lot).repartition(*place)
        .groupBy("agreement_naturalkey", *place, *lot).agg(F.count(F.lit(1)).alias("_rows"))
    )
    lists = [f"_{n}" for n in DAY_HORIZONS]
    if lots:
        lists = ["_lots", *lists]
        counted = counted.groupBy("agreement_naturalkey", *place).agg(
            F.collect_list(F.struct(*lot, F.col("_rows").alias("_n"))).alias("_lots"),
            F.sum("_rows").alias("_rows"))

    def multiplied(name: str) -> Column:
        return F.transform(
            f"_{name}", lambda e: F.struct((e["qty"] * F.col("_rows")).alias("qty")))

    placed = counted.join(per_place, place, "left" if lots else "inner").withColumns(
        {f"_{n}": multiplied(n) for n in DAY_HORIZONS})
    return placed.groupBy("agreement_naturalkey").agg(
        *[F.flatten(F.collect_list(c)).alias(c) for c in lists])


def _with_lots(df: DataFrame) -> DataFrame:
    """A row per plan row and sum of each horizon, from the lists of `_needs_per_agreement`."""
    lots = F.flatten(F.transform("_lots", lambda e: F.array_repeat(
        e["mm_minimum_lot_size"], e["_n"].cast("int"))))
    return (
        df.withColumn("mm_minimum_lot_size", F.explode(lots))
        .withColumn("_n13", F.explode_outer("_n13"))
        .withColumn("_n12m", F.explode_outer("_n12m"))
        .withColumn("qty_consumption_per_day", daily_consumption("_n13.qty"))
        .withColumn("total_requirement_qty", F.col("_n12m.qty"))
        .drop("_lots", "_n13", "_n12m")
        .withColumn(
            "mm_minimum_lot_size_dfc", cover_days("mm_minimum_lot_size", "qty_consumption_per_day")
        )
    )


def _on_source_list(agr: DataFrame) -> DataFrame:
    return agr.filter(F.col("source_list_flag") == "Y").select(*AGREEMENT_COLUMNS)


def _batches(sync: DataFrame) -> DataFrame:
    return sync.select("plant_code", "material_id",
                       F.col("batch_volume_uom").alias("avg_batch_consumption_qty"),
                       "usage_uom", "weight", "cov_usage", "inventory", "sync")


def _entries(inp: DataFrame) -> DataFrame:
    return inp.select(
        F.col("vendor_id").alias("purchase_vendor_id"), "material_id", "plant_code", "base_uom",
        "abc_mat_fam_name", "abc_mat_fam_new_msm", "restriction_min_prod_qty",
        "restriction_max_prod_qty", F.lit("").alias("supplier_storage_flag"),
        "material_per_pallet_qty", "min_prod_qty", "ticket_id", "setup_cost_usd",
        "prod_rounding_value", "material_shelf_life_months", "vendor_plant_change_freq",
        "supplier_input_repeats",
    )


def _overrides(ovr: DataFrame) -> DataFrame:
    return ovr.select(
        left_padded("vendor_id", VENDOR_WIDTH).alias("purchase_vendor_id"),
        left_padded("material_id", MATERIAL_WIDTH).alias("material_id"),
        left_padded("ticket_id", TICKET_WIDTH).alias("ticket_id"),
        "qty_forecast_override",
    )


def _ticket_flags(trig: DataFrame) -> DataFrame:
    return trig.select(
        F.col("vendor_id").alias("purchase_vendor_id"), "ticket_id", "forecast_override_flag",
        F.col("future_supplier_storage_flag").alias("future_flag_supplier_inv_storage"),
    )


def keyed_by_material(df: DataFrame, lookup: bool = True) -> DataFrame:
    """`material_id` as a value that is never null, `_material`; a lookup needs no row without one."""
    kept = df.filter(F.col("material_id").isNotNull()) if lookup else df
    return kept.withColumn("_material", F.struct("material_id")).drop("material_id")


def dealt_by_material(df: DataFrame, lookup: bool = True) -> DataFrame:
    """Rows dealt by `_material`, so that frames dealt alike meet without another exchange."""
    return keyed_by_material(df, lookup).repartition("_material")


def agreement_needs(
    agr: DataFrame, plan: DataFrame, needs: DataFrame,
    keys: Sequence[str] = ("agreement_naturalkey", "material_id"),
) -> DataFrame:
    """The keys of the agreements on the source list that have a plan, each once, with its lists."""
    listed = _on_source_list(agr).select(*keys).repartition("agreement_naturalkey").distinct()
    return listed.join(_needs_per_agreement(plan, needs, lots=True), "agreement_naturalkey")


def enrich_by_material(
    agr: DataFrame,
    measured: DataFrame,
    sync: DataFrame,
    inp: DataFrame,
    ovr: DataFrame,
    trig: DataFrame,
    mat: DataFrame | None,
    plant: DataFrame,
    fin: DataFrame,
    latest: bool = False,
) -> DataFrame:
    """`enrich_agreements` on rows dealt by material, which stay so; `_material` holds `material_id`.

    `measured` comes from `agreement_needs`. Tickets are asked for on narrow rows, and only those
    found come back. With `latest`, a key's input is that of its highest ticket.
    """
    own = [c for c in measured.columns if c in AGREEMENT_COLUMNS and c not in (
        "agreement_naturalkey", "material_id")]
    line = ["_material", "agreement_naturalkey", *(["_own"] if own else [])]

    def told_apart(df: DataFrame) -> DataFrame:
        return df.withColumn("_own", F.struct(*own)) if own else df

    met = told_apart(dealt_by_material(_on_source_list(agr), lookup=False)).join(
        told_apart(dealt_by_material(measured, lookup=False)).drop(*own), line)
    lines = _with_lots(met).drop("_own", "agreement_naturalkey")

    place = ["_material", "plant_code"]
    entry = ["_material", "ticket_id", "purchase_vendor_id"]
    offered = _entries(inp).filter(
        F.col("purchase_vendor_id").isNotNull() & F.col("plant_code").isNotNull())
    given = dealt_by_material(offered)
    if latest:
        given = latest_by_max_join(given, [*place, "purchase_vendor_id"], dealt=True)
    ticket = ["ticket_id", "purchase_vendor_id"]
    flags = (
        keyed_by_material(offered.select("material_id", *ticket)).repartition(*ticket).distinct()
        .join(_ticket_flags(trig), ticket).repartition("_material")
    )
    with_ticket = given.distinct().join(
        dealt_by_material(_overrides(ovr)), entry, "left").join(flags, entry, "left")
    with_input = lines.join(dealt_by_material(_batches(sync)), place, "left").join(
        with_ticket, [*place, "purchase_vendor_id"], "left")
    described = with_input if mat is None else with_input.join(
        dealt_by_material(mat.select(F.col("material_number").alias("material_id"), "material_desc")),
        "_material", "left")
    resolved = drop_duplicated_tickets(
        resolve_forecast(described).withColumn(
            "min_prod_qty_dfc", cover_days("min_prod_qty", "qty_consumption_per_day")
        )
    )
    rates = plant.select(F.col("site_code").alias("plant_code"), "country_code").join(
        fin.select("country_code", "nominal_wacc", "scrap_extra_charges"), "country_code", "left")
    return resolved.join(rates, "plant_code", "left").drop(
        "total_requirement_qty", "qty_forecast_override", "forecast_override_flag", "country_code")


def enrich_agreements(
    agr: DataFrame,
    plan: DataFrame,
    needs: DataFrame,
    sync: DataFrame,
    inp: DataFrame,
    ovr: DataFrame,
    trig: DataFrame,
    mat: DataFrame | None,
    plant: DataFrame,
    fin: DataFrame,
) -> DataFrame:
    """Agreement lines on the source list with plan, forecast, input, ticket and rates.

    `needs` is `consumption_by_horizon` per material, plant and material type, so the
    consumption table is read once and reduced before it meets any other. Both sides of every
    join are plain tables: adaptive execution broadcasts the small ones by their measured size
    and splits skewed partitions of the large ones. Without `mat`, `material_desc` is left out.
    """
    agreements = _on_source_list(agr)
    measured = _with_lots(agreements.join(
        _needs_per_agreement(plan, needs, lots=True), "agreement_naturalkey"))
    synced = measured.join(_batches(sync), ["plant_code", "material_id"], "left")

    # Input rows are made distinct where they meet their override.
    entry = ["material_id", "ticket_id", "purchase_vendor_id"]
    given = _entries(inp).repartition(*entry).distinct()
    # An input row is matched to its override and ticket before it meets the agreement.
    with_ticket = given.join(_overrides(ovr), entry, "left").join(
        _ticket_flags(trig), ["ticket_id", "purchase_vendor_id"], "left")
    with_input = synced.join(with_ticket, PRICE_KEYS, "left")

    described = with_input if mat is None else with_input.join(
        mat.select(F.col("material_number").alias("material_id"), "material_desc"),
        "material_id", "left",
    )
    resolved = drop_duplicated_tickets(
        resolve_forecast(described).withColumn(
            "min_prod_qty_dfc", cover_days("min_prod_qty", "qty_consumption_per_day")
        )
    )
    return (
        resolved.join(plant.select(F.col("site_code").alias("plant_code"), "country_code"),
                      "plant_code", "left")
        .join(fin.select("country_code", "nominal_wacc", "scrap_extra_charges"),
              "country_code", "left")
        .drop("agreement_naturalkey", "total_requirement_qty", "qty_forecast_override",
              "forecast_override_flag", "country_code")
    )


def add_ticket_details(df: DataFrame, trig: DataFrame, how: str = "left") -> DataFrame:
    """Owner, title and horizon of the row's ticket."""
    return df.join(
        trig.select("ticket_id", "modified_date", "ticket_owner", "ticket_custom_id",
                    "ticket_title", "pipo_horizon_days"),
        "ticket_id", how,
    )


def override_pallet_qty(df: DataFrame, storage: DataFrame) -> DataFrame:
    """Storage unit of (vendor, material) in place of the pallet quantity, where known."""
    units = storage.select(
        F.col("vendor_id").alias("purchase_vendor_id"), "material_id", "storage_unit_quantity"
    )
    return (
        df.join(units, ["purchase_vendor_id", "material_id"], "left")
        .withColumn(
            "material_per_pallet_qty",
            F.coalesce(F.col("storage_unit_quantity"), F.col("material_per_pallet_qty")),
        )
        .select(*df.columns)
    )


def initiatives_per_pair(
    initiatives: DataFrame,
    po: str = "iopt_initiative_po_material_id",
    pi: str = "iopt_initiative_pi_material_id",
    name: str = "iopt_initiative_name",
    distinct: bool = False,
) -> DataFrame:
    """Cleaned initiative names per phase-out/phase-in pair and plant, in name order.

    Equal names are counted before the shuffle and repeated in the joined text; `distinct`
    names each once, which keeps the text short whatever the copies.
    """
    cleaned = F.regexp_replace(F.lower(name), "[^a-zA-Z0-9]", " ")
    counted = (
        initiatives.withColumn(name, cleaned)
        .groupBy(po, "plant_code", pi, name)
        .agg(F.lit(1).alias("_times") if distinct
             else F.count(F.lit(1)).cast("int").alias("_times"))
    )
    pairs = F.array_sort(F.collect_list(F.when(F.col(name).isNotNull(), F.struct(name, "_times"))))
    repeated = F.flatten(F.transform(pairs, lambda p: F.array_repeat(p[name], p["_times"])))
    return (
        counted.groupBy(po, "plant_code", pi)
        .agg(F.concat_ws(", ", repeated).alias(name))
        .withColumn(
            "material_phase_out_phase_in",
            F.concat_ws(" - ", strip_leading_zeros(po), strip_leading_zeros(pi)),
        )
    )


def phase_in_out(df: DataFrame, init: DataFrame, side: str = "both") -> DataFrame:
    """Initiative that phases the row's material out ('PO') or in ('PI').

    `side` is "both" (the phase-out match first), or "pi" or "po" for a join on one side
    only. A one-sided match says 'PO' whenever its pair names a phased-out material.
    """
    po, pi = "iopt_initiative_po_material_id", "iopt_initiative_pi_material_id"
    details = [pi, "iopt_initiative_name", "material_phase_out_phase_in"]
    if side == "both":
        out_side = init.select(F.col(po).alias("material_id"), "plant_code", F.lit("PO").alias("_po"),
                               *[F.col(c).alias(f"_po_{c}") for c in details])
        in_side = init.select(F.col(pi).alias("material_id"), "plant_code", F.lit("PI").alias("_pi"),
                              *[F.col(c).alias(f"_pi_{c}") for c in details])
        joined = df.join(out_side, ["material_id", "plant_code"], "left").join(
            in_side, ["material_id", "plant_code"], "left"
        )
        found = [F.coalesce(F.col(f"_po_{c}"), F.col(f"_pi_{c}")).alias(c) for c in details]
        return joined.select(*df.columns, *found, F.coalesce("_po", "_pi").alias("pipo_indicator"))

    key = {"pi": pi, "po": po}[side]
    matched = init.select(F.col(key).alias("material_id"), "plant_code", *details,
                          F.col(po).alias("_po"))
    joined = df.join(matched, ["material_id", "plant_code"], "left")
    indicator = F.coalesce(F.when(F.col("_po").isNotNull(), "PO"),
                           F.when(F.col(pi).isNotNull(), "PI"))
    return joined.withColumn("pipo_indicator", indicator).select(
        *df.columns, *details, "pipo_indicator"
    )


def joined_set(column: str | Column, separator: str = ", ") -> Column:
    """Distinct values in order, as one text; as an aggregate it combines before the shuffle."""
    return F.concat_ws(separator, F.array_sort(F.collect_set(column)))


def collapse_lines(
    df: DataFrame,
    keys: Sequence[str],
    texts: Sequence[str] = (
        "iopt_initiative_name", "iopt_initiative_pi_material_id", "material_phase_out_phase_in",
    ),
) -> DataFrame:
    """One row per key; the distinct initiatives of the merged rows joined in order."""
    return df.groupBy(*keys).agg(*[joined_set(t).alias(t) for t in texts])


def harmonise_price_lines(
    df: DataFrame,
    keys: Sequence[str] = tuple(PRICE_KEYS),
    factor: str = "price_unit_factor",
    currency: str = "doc_curr_code",
    rescale: bool = False,
    price_columns: Sequence[str] = ("price_purch_rate", "price_purch_rate_usd"),
    combos: DataFrame | None = None,
) -> DataFrame:
    """Price lines of one key brought to one unit factor.

    A currency with one factor keeps its lines, one with several has the factor set to 1,
    and a key in which one factor comes with several currencies is dropped whole. The case
    of a currency applies to all lines of its key, so a line is repeated once for every
    currency of the key. With `rescale`, prices are divided by the factor they lose.

    `combos` may hold the keys, factors and currencies of the lines, dealt by one of the keys as
    the lines are; no line is then shuffled, nor read for them. Their keys must not be null.
    """
    keys = list(keys)
    if combos is None:
        kept = _written_price_cases(df, keys, factor, currency)
    else:
        kept = _dealt_price_cases(combos.select(*keys, factor, currency), keys, factor, currency)
    lines = df.join(kept, keys)
    repeated = lines.withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), (F.col("_single") + F.col("_several")).cast("int")))
    )
    changed = F.col("_copy") > F.col("_single")
    updates = {}
    if rescale:
        updates = {
            c: F.when(changed, F.try_divide(F.col(c), F.col(factor))).otherwise(F.col(c))
            for c in price_columns if c in df.columns
        }
    updates[factor] = F.when(changed, F.lit(1).cast(df.schema[factor].dataType)).otherwise(
        F.col(factor)
    )
    return repeated.withColumns(updates).select(*df.columns)


def _dealt_price_cases(
    combos: DataFrame, keys: list[str], factor: str, currency: str
) -> DataFrame:
    """Currencies with one factor and with several per key that mixes none, where combos are.

    A factor has several currencies when there are more combos than factors.
    """
    per_currency = combos.distinct().groupBy(*keys, currency).agg(
        F.count(F.lit(1)).alias("_n"), F.collect_set(F.struct(factor)).alias("_factors"))
    factors = F.size(F.array_distinct(F.flatten(F.collect_list("_factors"))))
    return (
        per_currency.groupBy(*keys)
        .agg(F.sum((F.col("_n") == 1).cast("long")).alias("_single"),
             F.sum((F.col("_n") > 1).cast("long")).alias("_several"),
             F.sum("_n").alias("_combos"), factors.alias("_factors"))
        .filter("_combos = _factors").drop("_combos", "_factors")
    )


def _written_price_cases(df: DataFrame, keys: list[str], factor: str, currency: str) -> DataFrame:
    combos = df.select(*keys, factor, currency).distinct()
    per_currency = combos.groupBy(*keys, currency).agg(F.count(F.lit(1)).alias("_n"))
    per_factor = combos.groupBy(*keys, factor).agg(F.count(F.lit(1)).alias("_n"))
    none = F.lit(0).cast("long")
    cases = (
        per_currency.select(*keys, (F.col("_n") == 1).cast("long").alias("_single"),
                            (F.col("_n") > 1).cast("long").alias("_several"), none.alias("_mixed"))
        .unionByName(
            per_factor.select(*keys, none.alias("_single"), none.alias("_several"),
                              (F.col("_n") > 1).cast("long").alias("_mixed"))
        )
        .groupBy(*keys)
        .agg(F.sum("_single").alias("_single"), F.sum("_several").alias("_several"),
             F.max("_mixed").alias("_mixed"))
    )
    # Plain keys, as null ones go: a grouping by more than the keys then needs no exchange of its
    # own. The cases are written, so that their side has one and a hot key can still be split.
    return cut_lineage(cases.filter("_mixed = 0").drop("_mixed"), "cases")


def average_prices(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str] = PRICE_MEASURES
) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(m).alias(m) for m in measures])


def padded_overrides(ovr: DataFrame) -> DataFrame:
    """Override keys padded from the left, as the planning steps expect them."""
    widths = {"vendor_id": VENDOR_WIDTH, "plant_code": PLANT_WIDTH,
              "material_id": MATERIAL_WIDTH, "ticket_id": TICKET_WIDTH}
    return ovr.withColumns({c: left_padded(c, w) for c, w in widths.items()})
