"""Production-quantity search and payload operators over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import R, query, rounded
from lotcraft.operators import mpq as M
from lotcraft.operators import payload as Y

KEYS = ["ticket_id", "material_id", "plant_code", "purchase_vendor_id"]
FAMILY = "PARTITION BY ticket_id, abc_mat_fam_new_msm"
FAMILY_R = "PARTITION BY r.ticket_id, abc_mat_fam_new_msm"
UNIT_PRICE = "price_purch_rate_usd / price_unit_factor"
OWN = "future_flag_supplier_inv_storage = 'No'"

SPENT = f"""
    priced AS (SELECT *, {UNIT_PRICE} * annual_fcst_cons_current AS spend_gcas FROM {{line}}),
    spent AS (
        SELECT *,
               CASE WHEN {OWN} THEN annual_fcst_cons_current
                    ELSE sum(annual_fcst_cons_current) OVER ({FAMILY}) END AS forecast_family,
               CASE WHEN {OWN} THEN spend_gcas ELSE sum(spend_gcas) OVER ({FAMILY}) END
                   AS spend_family,
               count(material_id) OVER ({FAMILY}) AS material_count,
               sum(spend_gcas) OVER (PARTITION BY ticket_id) AS ticket_spend
        FROM priced),
    shared AS (
        SELECT *, {R('spend_gcas / ticket_spend', 2)} AS spend_gcas_percentage,
               {R('spend_family / ticket_spend', 2)} AS spend_family_percentage
        FROM spent)"""


@query("family_spend", f"""
    WITH {SPENT}
    SELECT {', '.join(KEYS)}, annual_fcst_cons_current, forecast_family,
           {R('spend_gcas')} AS spend_gcas, {R('spend_family', 1)} AS spend_family,
           material_count, spend_gcas_percentage, spend_family_percentage
    FROM shared""")
def _(f):
    return M.family_spend(f.line).select(
        *KEYS, "annual_fcst_cons_current", "forecast_family",
        rounded("spend_gcas").alias("spend_gcas"),
        rounded("spend_family", 1).alias("spend_family"), "material_count",
        rounded("spend_gcas_percentage", 2).alias("spend_gcas_percentage"),
        rounded("spend_family_percentage", 2).alias("spend_family_percentage"),
    )


@query("cumulative_family_share", f"""
    WITH {SPENT},
    families AS (
        SELECT ticket_id, abc_mat_fam_new_msm,
               {R('avg(spend_family_percentage)', 2)} AS spend_family_percentage
        FROM shared GROUP BY ticket_id, abc_mat_fam_new_msm),
    ranked AS (
        SELECT *, {R('''sum(spend_family_percentage) OVER (PARTITION BY ticket_id
                        ORDER BY spend_family_percentage DESC, abc_mat_fam_new_msm
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)''', 2)}
                   AS accumulated_family_percentage
        FROM families)
    SELECT {', '.join('s.' + k for k in KEYS)}, s.annual_fcst_cons_current,
           r.spend_family_percentage, accumulated_family_percentage
    FROM shared s JOIN ranked r ON s.ticket_id = r.ticket_id
      AND s.abc_mat_fam_new_msm = r.abc_mat_fam_new_msm""")
def _(f):
    return M.cumulative_family_share(M.family_spend(f.line)).select(
        *KEYS, "annual_fcst_cons_current",
        rounded("spend_family_percentage", 2).alias("spend_family_percentage"),
        rounded("accumulated_family_percentage", 2).alias("accumulated_family_percentage"),
    )


@query("explode_scenarios", """
    SELECT s_suppkey, CAST(iteration AS INT) AS iteration FROM supplier, range(1, 51) AS steps(iteration)""")
def _(f):
    return M.explode_scenarios(f.supplier.select("s_suppkey"))


RESTRICTED = f"""
    restricted AS (
        SELECT *, min(CAST(restriction_min_prod_qty AS DECIMAL(10,2))) OVER ({FAMILY}) AS low,
               min(CAST(restriction_max_prod_qty AS DECIMAL(10,2))) OVER ({FAMILY}) AS high
        FROM {{line}})"""


@query("family_restrictions", f"""
    WITH {RESTRICTED}
    SELECT {', '.join(KEYS)}, qty_forecast_n12, CAST(low AS DOUBLE) AS fam_restriction_min_prod_qty,
           CAST(high AS DOUBLE) AS fam_restriction_max_prod_qty FROM restricted""")
def _(f):
    names = ("fam_restriction_min_prod_qty", "fam_restriction_max_prod_qty")
    return M.family_restrictions(f.line).select(
        *KEYS, "qty_forecast_n12", *[F.col(c).cast("double").alias(c) for c in names])


STEP = "(high - low) * iteration / 50"
ROUNDED_STEP = f"CAST(ceil(CAST({STEP} AS DOUBLE) / prod_rounding_value) AS DOUBLE) " \
               "* prod_rounding_value"


@query("mpq_steps", f"""
    WITH {RESTRICTED},
    steps AS (
        SELECT ticket_id, abc_mat_fam_new_msm, abc_mat_fam_new_msm || '_' || CAST(iteration AS
                   STRING) AS concat_family_iteration, {ROUNDED_STEP} AS mpq_iteration
        FROM restricted, range(1, 51) AS i(iteration))
    SELECT ticket_id, concat_family_iteration, count(*) AS n_rows,
           min(mpq_iteration) AS least, max(mpq_iteration) AS most, sum(mpq_iteration) AS total
    FROM steps GROUP BY ticket_id, concat_family_iteration""")
def _(f):
    steps = M.mpq_steps(M.explode_scenarios(M.family_restrictions(f.line)))
    return steps.groupBy("ticket_id", "concat_family_iteration").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("mpq_iteration").alias("least"),
        F.max("mpq_iteration").alias("most"), F.sum("mpq_iteration").alias("total"))


COSTS = f"""
    {RESTRICTED},
    families AS (
        SELECT r.*, g.current_supplier_storage_flag AS storage_now, {UNIT_PRICE} AS price,
               count(material_id) OVER ({FAMILY_R}) AS material_count,
               CASE WHEN {OWN} THEN annual_fcst_cons_current
                    ELSE sum(annual_fcst_cons_current) OVER ({FAMILY_R}) END AS forecast_family
        FROM restricted r LEFT JOIN {{line_flag}} g ON g.ticket_id = r.ticket_id),
    scenarios AS (
        SELECT *, {ROUNDED_STEP} AS mpq,
               {ROUNDED_STEP} * {R('annual_fcst_cons_current / forecast_family', 2)} AS allocated
        FROM families, range(1, 51) AS i(iteration)),
    measured AS (
        SELECT *, allocated * 365 / annual_fcst_cons_current AS cover,
               CASE WHEN storage_now = 'No' THEN allocated
                    WHEN mm_minimum_lot_size IS NULL THEN CAST(material_per_pallet_qty AS DOUBLE)
                    ELSE mm_minimum_lot_size END AS order_quantity
        FROM scenarios),
    risks AS (
        SELECT *, greatest(0, annual_fcst_cons_current
                   * greatest(cover - material_shelf_life_months, cover - pipo_horizon_days,
                              cover - vendor_plant_change_freq) / 365 * price) AS risk,
               CAST(nominal_wacc AS DOUBLE) * order_quantity * price / 2 AS capital,
               annual_fcst_cons_current * setup_cost_usd / nullif(allocated, 0)
                   / CASE WHEN {OWN} THEN 1 ELSE material_count END AS setup
        FROM measured),
    costs AS (
        SELECT *, risk * CAST(scrap_extra_charges AS DOUBLE) AS scrap,
               coalesce(setup, 0) + coalesce(capital, 0) + risk
                   + risk * CAST(scrap_extra_charges AS DOUBLE) AS cost
        FROM risks)"""


def _rows(f):
    return M.scenario_rows(M.prepare_scenarios(f.line, f.line_flag))


@query("scenario_costs", f"""
    WITH {COSTS}
    SELECT ticket_id, CAST(iteration AS INT) AS iteration, abc_segment, count(*) AS n_rows,
           {R('sum(mpq)', 2)} AS mpq,
           {R('sum(allocated)', 2)} AS allocated, {R('sum(cover)', 2)} AS cover,
           {R('sum(order_quantity)', 2)} AS order_quantity, {R('sum(risk)', 2)} AS risk,
           {R('sum(scrap)', 2)} AS scrap, {R('sum(capital)', 2)} AS capital
    FROM costs GROUP BY ticket_id, iteration, abc_segment""")
def _(f):
    measures = {
        "mpq": "mpq_iteration", "allocated": "mpq_sc_alloc_uom", "cover": "mpq_sc_alloc_dfc",
        "order_quantity": "moq_sc_uom", "risk": "ide_risk_sc_usd", "scrap": "log_scrap_sc_usd",
        "capital": "total_wacc_sc_usd",
    }
    return _rows(f).groupBy("ticket_id", "iteration", "abc_segment").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[rounded(F.sum(c), 2).alias(out) for out, c in measures.items()])


@query("total_supply_chain_cost", f"""
    WITH {COSTS}
    SELECT ticket_id, material_id, plant_code, count(*) AS n_rows, {R('sum(setup)', 2)} AS setup,
           {R('sum(cost)', 2)} AS cost, {R('max(cost)', 2)} AS most
    FROM costs GROUP BY ticket_id, material_id, plant_code""")
def _(f):
    cost = "total_supply_chain_cost_gcas"
    return _rows(f).groupBy("ticket_id", "material_id", "plant_code").agg(
        F.count(F.lit(1)).alias("n_rows"), rounded(F.sum("setup_cost"), 2).alias("setup"),
        rounded(F.sum(cost), 2).alias("cost"), rounded(F.max(cost), 2).alias("most"))


DECIDED = f"""
    {COSTS},
    decided AS (
        SELECT *, ROUND(CASE WHEN {OWN} THEN cost
               ELSE sum(cost) OVER (PARTITION BY ticket_id, abc_mat_fam_new_msm, iteration) END, 6)
                   AS decisive
        FROM costs),
    lowest AS (SELECT *, min(decisive) OVER ({FAMILY}) AS least FROM decided)"""


@query("family_cost_minimum", f"""
    WITH {DECIDED}
    SELECT ticket_id, abc_mat_fam_new_msm, {R('least', 2)} AS least, count(*) AS n_rows,
           CAST(sum(CASE WHEN decisive <= least + 0.00001 THEN 1 ELSE 0 END) AS BIGINT) AS n_lowest,
           {R('sum(decisive)', 1)} AS decisive
    FROM lowest GROUP BY ticket_id, abc_mat_fam_new_msm, least""")
def _(f):
    rows = M.family_cost_minimum(M.prepare_scenarios(f.line, f.line_flag))
    least, decisive = "min_supply_chain_cost_accross_fam_iterations", "supply_chain_cost_fam_level"
    near = F.when(F.col(decisive) <= F.col(least) + 0.00001, 1).otherwise(0)
    return rows.groupBy("ticket_id", "abc_mat_fam_new_msm").agg(
        rounded(F.max(least), 2).alias("least"), F.count(F.lit(1)).alias("n_rows"),
        F.sum(near).alias("n_lowest"), rounded(F.sum(decisive), 1).alias("decisive"))


BEST = f"""
    {DECIDED},
    best AS (
        SELECT ticket_id, abc_mat_fam_new_msm, {R('min(mpq)', 2)} AS optimal_mpq
        FROM lowest WHERE decisive <= least + 0.00001 GROUP BY ticket_id, abc_mat_fam_new_msm)"""


@query("optimal_mpq", f"WITH {BEST} SELECT * FROM best")
def _(f):
    return M.optimal_mpq(_rows(f)).select("ticket_id", "abc_mat_fam_new_msm", "optimal_mpq")


@query("optimal_weighted_runs", f"""
    WITH {BEST},
    runs AS (
        SELECT f.*, optimal_mpq, forecast_family / nullif(optimal_mpq, 0) AS runs,
               sum(forecast_family) OVER (PARTITION BY f.ticket_id, abc_segment) AS segment_total
        FROM families f LEFT JOIN best b ON b.ticket_id = f.ticket_id
          AND b.abc_mat_fam_new_msm = f.abc_mat_fam_new_msm)
    SELECT ticket_id, material_id, plant_code, purchase_vendor_id, qty_forecast_n12, optimal_mpq,
           CASE WHEN setup_cost_usd IS NOT NULL
                THEN {R('runs * forecast_family / segment_total', 2)} END
               AS opt_annual_runs_weighted
    FROM runs""")
def _(f):
    prepared = M.prepare_scenarios(f.line, f.line_flag)
    best = M.optimal_mpq(M.scenario_rows(prepared))
    df = M.optimal_weighted_runs(M.attach_optimal_mpq(prepared, best))
    return df.select(*KEYS, "qty_forecast_n12", "optimal_mpq",
                     rounded("opt_annual_runs_weighted", 2).alias("opt_annual_runs_weighted"))


BLANKED = "CASE WHEN {0} IS NULL OR trim({0}) = '' THEN '' ELSE {0} END"


@query("nulls_to_blank", f"""
    SELECT purchase_vendor_id, material_id, plant_code, mm_minimum_lot_size,
           {BLANKED.format('pipo_indicator')} AS pipo_indicator,
           {BLANKED.format('qty_forecast_n12')} AS qty_forecast_n12,
           coalesce(CAST(min_prod_qty AS STRING), '') AS min_prod_qty
    FROM {{fact}}""")
def _(f):
    return Y.nulls_to_blank(f.fact.select(
        "purchase_vendor_id", "material_id", "plant_code", "mm_minimum_lot_size",
        "pipo_indicator", "qty_forecast_n12", "min_prod_qty"))


@query("blanks_to_null", """
    SELECT vendor_id, plant_code, ticket_id, nullif(trim(material_id), '') AS material_id,
           nullif(material_phase_out_phase_in, '') AS material_phase_out_phase_in, min_prod_qty
    FROM {input_raw}""")
def _(f):
    return Y.blanks_to_null(f.input_raw.select(
        "vendor_id", "plant_code", "ticket_id", "material_id", "material_phase_out_phase_in",
        "min_prod_qty"))


JSON_COLUMNS = ["material_id", "plant_code", "purchase_vendor_id", "pipo_indicator", "min_prod_qty"]
JSON = "'{\"Values\":[' || " + " || ',' || ".join(
    f"to_json(coalesce(CAST({c} AS STRING), ''))" for c in JSON_COLUMNS) + " || ']}'"


# Braces of the JSON text are kept apart from the frame names by their quotes.
@query("row_json", f"SELECT material_id, plant_code, {JSON} AS json FROM {{fact}}")
def _(f):
    return Y.row_json(f.fact, JSON_COLUMNS, "json").select("material_id", "plant_code", "json")


DOC_JSON = "'{\"Values\":[' || to_json(coalesce(text, '')) || ',' || " \
           "to_json(coalesce(lang, '')) || ']}'"
PLAIN = f"regexp_replace({DOC_JSON}, '[^\\x00-\\x7F]', '', 'g')"


def _documents(f):
    return Y.row_json(f.documents, ["text", "lang"])


@query("region_rows", f"""
    SELECT doc_id, {PLAIN} AS json FROM documents WHERE source IN ('src1', 'src2', 'src5')""")
def _(f):
    rows = Y.region_rows(_documents(f), ["src1", "src2", "src5"], system="source")
    return rows.select("doc_id", F.col("jsonObject").alias("json"))


# Exact copies of a document are exact copies of a payload row.
@query("region_payload", f"""
    WITH cleaned AS (
        SELECT {PLAIN} AS json FROM documents WHERE lang IN ('en', 'fr')),
    counted AS (
        SELECT json, count(*) AS copies, CAST('0x' || substr(md5(json), 1, 8) AS BIGINT) AS code
        FROM cleaned GROUP BY json),
    needed AS (SELECT greatest(1, CAST(ceil(sum(copies % 4) / 4) AS BIGINT)) AS n FROM counted),
    placed AS (
        SELECT json, copies % 4 AS rest, code % n AS bucket FROM counted, needed
        WHERE copies % 4 > 0),
    started AS (
        SELECT *, CAST(sum(rest) OVER (PARTITION BY bucket ORDER BY encode(json)) AS BIGINT) - rest
                  AS start FROM placed),
    pieces AS (
        SELECT json, bucket, start // 4 + k AS slice,
               least(start + rest, (start // 4 + k + 1) * 4) - greatest(start, (start // 4 + k) * 4)
               AS times
        FROM started, range(0, 2) AS r(k)),
    own AS (SELECT json, unnest(range(copies // 4)) AS slice FROM counted)
    SELECT bucket, slice, CAST(sum(times) AS BIGINT) AS rows,
           string_agg(repeat(json || ',', CAST(times - 1 AS INT)) || json, ','
                      ORDER BY encode(json)) AS body
    FROM pieces WHERE times > 0 GROUP BY bucket, slice
    UNION ALL
    SELECT -1, slice, 4, repeat(json || ',', 3) || json FROM own""")
def _(f):
    return Y.region_payload(_documents(f), ["en", "fr"], 4, system="lang")


@query("write_payload", f"""
    SELECT source, {PLAIN} AS json FROM documents WHERE source IN ('src1', 'src2', 'src5')""")
def _(f):
    from lotcraft.sources import write_payload
    from lotcraft.sources.staging import new_folder

    path = new_folder(f.spark, "payload")
    rows = Y.region_rows(_documents(f), ["src1", "src2", "src5"], system="source")
    write_payload(rows, path, "jsonObject", 50, ["source"])
    return f.spark.read.text(path).select("source", F.col("value").alias("json"))
