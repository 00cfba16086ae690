"""Forecast, enrichment, price-line and classification operators over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.domain import AS_OF
from catalog.registry import R, query, rounded
from lotcraft.operators import classify as K
from lotcraft.operators import planning as P

PAIR = ["purchase_vendor_id", "plant_code", "material_id"]


@query("abc_by_brand", f"""
    WITH spent AS (
        SELECT p_type, p_brand, sum(l_extendedprice) AS spend
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type, p_brand),
    shares AS (
        SELECT p_type, p_brand, {R('spend', 2)} AS total_spend,
               {R('100 * spend / sum(spend) OVER (PARTITION BY p_type)', 2)} AS percentage
        FROM spent),
    ranked AS (
        SELECT *, {R('''sum(percentage) OVER (PARTITION BY p_type ORDER BY percentage DESC, p_brand
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)''', 2)} AS accumulated
        FROM shares)
    SELECT *, CASE WHEN accumulated <= 80 THEN 'A' WHEN accumulated <= 95 THEN 'B' ELSE 'C' END
               AS abc_segment
    FROM ranked""")
def _(f):
    lines = f.lineitem.select("l_partkey", "l_extendedprice").join(
        f.part.select("p_partkey", "p_type", "p_brand"), F.col("l_partkey") == F.col("p_partkey")
    )
    shares = K.spend_and_share(lines, "p_type", "p_brand", "l_extendedprice")
    classes = K.abc_classify(shares, "p_type", "p_brand")
    return classes.select("p_type", "p_brand", rounded("total_family_spend", 2).alias("total_spend"),
                          "percentage", "accumulated", "abc_segment")


@query("consumption_within_days", """
    SELECT material_id, plant_code, material_type,
           sum(sum_total_requirement_qty) AS total_requirement_qty
    FROM {consumption} WHERE requirement_date_for_the_component <= '19980402'
    GROUP BY material_id, plant_code, material_type""")
def _(f):
    return P.consumption_within_days(
        f.consumption, ["material_id", "plant_code", "material_type"], 91, AS_OF
    )


def _horizon(months_last: str, condition: str = "TRUE") -> str:
    return (f"sum(CASE WHEN {condition} AND substr(requirement_date_for_the_component, 1, 6) "
            f"BETWEEN '199801' AND '{months_last}' THEN sum_total_requirement_qty END)")


@query("consumption_month_horizons", f"""
    WITH planned AS (
        SELECT purchase_vendor_id, plant_code, material_id,
               {_horizon('199901', "material_type IN ('ROH', 'HALB')")} AS qty_forecast_n1y,
               {_horizon('199807')} AS qty_forecast_n6m, {_horizon('199804')} AS qty_forecast_n3m
        FROM {{consumption}} GROUP BY purchase_vendor_id, plant_code, material_id)
    SELECT *, qty_forecast_n6m * 2 AS qty_forecast_n6m_annualized,
           qty_forecast_n3m * 4 AS qty_forecast_n3m_annualized
    FROM planned WHERE qty_forecast_n1y IS NOT NULL""")
def _(f):
    return P.consumption_month_horizons(f.consumption, AS_OF)


@query("days_forward_cover", f"""
    WITH used AS (
        SELECT material_id, plant_code, sum(sum_total_requirement_qty) AS qty_consumption_n13
        FROM {{consumption}} WHERE requirement_date_for_the_component <= '19980402'
        GROUP BY material_id, plant_code)
    SELECT agreement_naturalkey, mm_minimum_lot_size,
           {R('qty_consumption_n13 / 91.0', 6)} AS qty_consumption_per_day,
           {R('mm_minimum_lot_size / nullif(qty_consumption_n13 / 91.0, 0)', 2)}
               AS mm_minimum_lot_size_dfc,
           {R('mm_minimum_lot_size / 4 / nullif(qty_consumption_n13 / 91.0, 0)', 2)}
               AS min_prod_qty_dfc
    FROM {{plan}} p JOIN used u ON u.material_id = p.material_id AND u.plant_code = p.plant_code""")
def _(f):
    used = P.consumption_within_days(
        f.consumption, ["material_id", "plant_code"], 91, AS_OF, "qty_consumption_n13"
    )
    lots = f.plan.select("agreement_naturalkey", "material_id", "plant_code",
                         "mm_minimum_lot_size",
                         (F.col("mm_minimum_lot_size") / 4).alias("min_prod_qty"))
    covered = P.days_forward_cover(lots.join(used, ["material_id", "plant_code"]))
    return covered.select("agreement_naturalkey", "mm_minimum_lot_size",
                          rounded("qty_consumption_per_day", 6).alias("qty_consumption_per_day"),
                          "mm_minimum_lot_size_dfc", "min_prod_qty_dfc")


@query("latest_by_max_join", """
    SELECT i.vendor_id, i.material_id, i.ticket_id, i.plant_code
    FROM {input} i JOIN (SELECT vendor_id, material_id, max(ticket_id) AS ticket_id FROM {input}
                         GROUP BY vendor_id, material_id) m
      ON i.vendor_id = m.vendor_id AND i.material_id = m.material_id AND i.ticket_id = m.ticket_id
    """)
def _(f):
    rows = f.input.select("vendor_id", "material_id", "ticket_id", "plant_code")
    return P.latest_by_max_join(rows, ["vendor_id", "material_id"])


@query("latest_by_rank", """
    SELECT material_id, plant_code, ticket_id, vendor_id FROM (
        SELECT *, dense_rank() OVER (PARTITION BY material_id, plant_code
                                     ORDER BY ticket_id DESC NULLS LAST) AS place
        FROM (SELECT material_id, plant_code, vendor_id,
                     CASE WHEN min_prod_qty < 25 THEN ticket_id END AS ticket_id FROM {input}))
    WHERE place = 1""")
def _(f):
    rows = f.input.select("material_id", "plant_code", "vendor_id",
                          F.when(F.col("min_prod_qty") < 25, F.col("ticket_id")).alias("ticket_id"))
    return P.latest_by_rank(rows, ["material_id", "plant_code"])


@query("storage_unit_per_key", """
    SELECT vendor_id, material_id, max(storage_unit_quantity) AS storage_unit_quantity
    FROM {storage} GROUP BY vendor_id, material_id""")
def _(f):
    return P.storage_unit_per_key(f.storage)


@query("resolve_forecast", """
    SELECT o.ticket_id, o.material_id, o.plant_code, o.vendor_id,
           CASE WHEN forecast_override_flag = 'yes' AND qty_forecast_override IS NOT NULL
                THEN qty_forecast_override ELSE CAST(pipo_horizon_days AS DOUBLE) END
               AS qty_forecast_n12,
           CASE WHEN forecast_override_flag = 'yes' THEN qty_forecast_override
                ELSE CAST(pipo_horizon_days AS DOUBLE) END AS qty_forecast_any
    FROM {override} o JOIN {ticket} t ON t.ticket_id = o.ticket_id""")
def _(f):
    rows = f.override.join(
        f.ticket.select("ticket_id", "forecast_override_flag", "pipo_horizon_days"), "ticket_id"
    )
    safe = P.resolve_forecast(rows, forecast="pipo_horizon_days")
    both = P.resolve_forecast(safe, forecast="pipo_horizon_days", out="qty_forecast_any",
                              need_value=False)
    return both.select("ticket_id", "material_id", "plant_code", "vendor_id", "qty_forecast_n12",
                       "qty_forecast_any")


@query("drop_duplicated_tickets", """
    SELECT material_id, plant_code, vendor_id, ticket_id, supplier_input_repeats FROM {input}
    WHERE supplier_input_repeats IS NULL OR supplier_input_repeats = 1""")
def _(f):
    return P.drop_duplicated_tickets(f.input.select(
        "material_id", "plant_code", "vendor_id", "ticket_id", "supplier_input_repeats"))


def _used(name: str, day: str) -> str:
    return f"""{name} AS (
        SELECT p.agreement_naturalkey, c.material_id, c.plant_code, c.material_type,
               sum(sum_total_requirement_qty) AS qty
        FROM {{consumption}} c JOIN {{plan}} p
          ON p.material_id = c.material_id AND p.plant_code = c.plant_code
        WHERE requirement_date_for_the_component <= '{day}'
        GROUP BY p.agreement_naturalkey, c.material_id, c.plant_code, c.material_type)"""


ENRICHED = ["source_system_code", "purchase_vendor_id", "plant_code", "material_id",
            "material_desc", "ticket_id", "qty_forecast_n12", "mm_minimum_lot_size_dfc",
            "min_prod_qty_dfc", "avg_batch_consumption_qty", "nominal_wacc",
            "scrap_extra_charges", "future_flag_supplier_inv_storage", "setup_cost_usd"]


@query("enrich_agreements", f"""
    WITH {_used('n13', '19980402')}, {_used('n12', '19990101')},
    given AS (SELECT DISTINCT * FROM {{input}}),
    overrides AS (SELECT lpad(vendor_id, 10, '0') AS vendor_id,
                         lpad(material_id, 18, '0') AS material_id, ticket_id,
                         qty_forecast_override FROM {{override}}),
    trig AS (SELECT * FROM {{ticket}} WHERE commercial_transparency_flag <> 'yes')
    SELECT a.source_system_code, a.purchase_vendor_id, a.plant_code, a.material_id,
           m.material_desc, i.ticket_id,
           CASE WHEN tg.forecast_override_flag = 'yes' AND o.qty_forecast_override IS NOT NULL
                THEN o.qty_forecast_override ELSE n12.qty END AS qty_forecast_n12,
           {R('p.mm_minimum_lot_size / (n13.qty / 91.0)', 2)} AS mm_minimum_lot_size_dfc,
           {R('i.min_prod_qty / (n13.qty / 91.0)', 2)} AS min_prod_qty_dfc,
           s.batch_volume_uom AS avg_batch_consumption_qty,
           CAST(fin.nominal_wacc AS DOUBLE) AS nominal_wacc,
           CAST(fin.scrap_extra_charges AS DOUBLE) AS scrap_extra_charges,
           tg.future_supplier_storage_flag AS future_flag_supplier_inv_storage, i.setup_cost_usd
    FROM {{agreement}} a JOIN {{plan}} p ON a.agreement_naturalkey = p.agreement_naturalkey
    LEFT JOIN n13 ON n13.agreement_naturalkey = a.agreement_naturalkey
    LEFT JOIN n12 ON n12.agreement_naturalkey = a.agreement_naturalkey
    LEFT JOIN {{sync}} s ON s.plant_code = a.plant_code AND s.material_id = a.material_id
    LEFT JOIN given i ON i.material_id = a.material_id AND i.plant_code = a.plant_code
      AND i.vendor_id = a.purchase_vendor_id
    LEFT JOIN overrides o ON o.material_id = i.material_id AND o.ticket_id = i.ticket_id
      AND o.vendor_id = i.vendor_id
    LEFT JOIN trig tg ON tg.ticket_id = i.ticket_id AND tg.vendor_id = i.vendor_id
    LEFT JOIN {{material_padded}} m ON m.material_number = a.material_id
    LEFT JOIN {{plant}} pl ON pl.site_code = a.plant_code
    LEFT JOIN {{finance}} fin ON fin.country_code = pl.country_code
    WHERE a.source_list_flag = 'Y'
      AND (i.supplier_input_repeats IS NULL OR i.supplier_input_repeats = 1)""")
def _(f):
    keys = ["material_id", "plant_code", "material_type"]
    df = P.enrich_agreements(
        f.agreement, f.plan, P.consumption_by_horizon(f.consumption, keys, AS_OF), f.sync, f.input,
        f.override, f.ticket.filter("commercial_transparency_flag <> 'yes'"), f.material_padded, f.plant,
        f.finance,
    )
    as_double = {c: F.col(c).cast("double") for c in ("nominal_wacc", "scrap_extra_charges")}
    return df.withColumns(as_double).select(*ENRICHED)


@query("override_pallet_qty", """
    SELECT i.vendor_id AS purchase_vendor_id, i.material_id, i.ticket_id,
           coalesce(q, CAST(material_per_pallet_qty AS DOUBLE)) AS material_per_pallet_qty
    FROM {input} i LEFT JOIN (
        SELECT vendor_id, material_id, max(storage_unit_quantity) AS q FROM {storage}
        GROUP BY vendor_id, material_id) s
      ON s.vendor_id = i.vendor_id AND s.material_id = i.material_id""")
def _(f):
    rows = f.input.select(F.col("vendor_id").alias("purchase_vendor_id"), "material_id",
                          "ticket_id", F.col("material_per_pallet_qty").cast("double")
                          .alias("material_per_pallet_qty"))
    return P.override_pallet_qty(rows, P.storage_unit_per_key(f.storage))


CLEAN = "regexp_replace(lower(iopt_initiative_name), '[^a-zA-Z0-9]', ' ', 'g')"
PAIRS = f"""
    pairs AS (
        SELECT iopt_initiative_po_material_id, plant_code, iopt_initiative_pi_material_id,
               string_agg({CLEAN}, ', ' ORDER BY {CLEAN}) AS iopt_initiative_name,
               regexp_replace(iopt_initiative_po_material_id, '^0+', '') || ' - ' ||
               regexp_replace(iopt_initiative_pi_material_id, '^0+', '')
                   AS material_phase_out_phase_in
        FROM source GROUP BY iopt_initiative_po_material_id, plant_code,
                             iopt_initiative_pi_material_id)"""
WIDE = """source AS (
        SELECT lpad(CAST(l_suppkey AS STRING), 18, '0') AS iopt_initiative_po_material_id,
               '0001' AS plant_code,
               lpad(CAST(l_linenumber AS STRING), 18, '0') AS iopt_initiative_pi_material_id,
               l_returnflag || '-' || l_linestatus AS iopt_initiative_name FROM lineitem)"""


@query("initiatives_per_pair", f"WITH {WIDE}, {PAIRS} SELECT * FROM pairs")
def _(f):
    source = f.lineitem.select(
        F.lpad(F.col("l_suppkey").cast("string"), 18, "0").alias("iopt_initiative_po_material_id"),
        F.lit("0001").alias("plant_code"),
        F.lpad(F.col("l_linenumber").cast("string"), 18, "0")
        .alias("iopt_initiative_pi_material_id"),
        F.concat_ws("-", "l_returnflag", "l_linestatus").alias("iopt_initiative_name"),
    )
    return P.initiatives_per_pair(source)


def _phase_sql(joins: str, columns: str) -> str:
    return f"""
    WITH source AS (SELECT * FROM {{initiative}}), {PAIRS},
    base AS (SELECT material_id, plant_code, count(*) AS n_rows FROM {{consumption}}
             GROUP BY material_id, plant_code)
    SELECT b.material_id, b.plant_code, n_rows, {columns} FROM base b {joins}"""


_OUT = """LEFT JOIN pairs o ON o.iopt_initiative_po_material_id = b.material_id
                  AND o.plant_code = b.plant_code"""
_IN = """LEFT JOIN pairs i ON i.iopt_initiative_pi_material_id = b.material_id
                  AND i.plant_code = b.plant_code"""
_DETAILS = ("iopt_initiative_pi_material_id", "iopt_initiative_name",
            "material_phase_out_phase_in")


def _base(f):
    return f.consumption.groupBy("material_id", "plant_code").agg(
        F.count(F.lit(1)).alias("n_rows"))


@query("phase_in_out", _phase_sql(
    f"{_OUT} {_IN}",
    ", ".join(f"coalesce(o.{c}, i.{c}) AS {c}" for c in _DETAILS)
    + ", CASE WHEN o.plant_code IS NOT NULL THEN 'PO' WHEN i.plant_code IS NOT NULL THEN 'PI' END"
      " AS pipo_indicator"))
def _(f):
    return P.phase_in_out(_base(f), P.initiatives_per_pair(f.initiative))


@query("phase_in_only", _phase_sql(
    _IN, ", ".join(f"i.{c} AS {c}" for c in _DETAILS)
    + ", CASE WHEN i.plant_code IS NOT NULL THEN 'PO' END AS pipo_indicator"))
def _(f):
    return P.phase_in_out(_base(f), P.initiatives_per_pair(f.initiative), side="pi")


@query("phase_out_only", _phase_sql(
    _OUT, ", ".join(f"o.{c} AS {c}" for c in _DETAILS)
    + ", CASE WHEN o.plant_code IS NOT NULL THEN 'PO' END AS pipo_indicator"))
def _(f):
    return P.phase_in_out(_base(f), P.initiatives_per_pair(f.initiative), side="po")


@query("collapse_lines", """
    SELECT purchase_vendor_id, plant_code,
           string_agg(DISTINCT business_unit, ', ' ORDER BY business_unit) AS business_unit,
           string_agg(DISTINCT doc_curr_code, ', ' ORDER BY doc_curr_code) AS doc_curr_code
    FROM {agreement} GROUP BY purchase_vendor_id, plant_code""")
def _(f):
    return P.collapse_lines(f.agreement, ["purchase_vendor_id", "plant_code"],
                            ["business_unit", "doc_curr_code"])


_PRICE_CASES = """
    combos AS (SELECT DISTINCT purchase_vendor_id, plant_code, material_id, price_unit_factor,
                      doc_curr_code FROM priced),
    c1 AS (SELECT purchase_vendor_id, plant_code, material_id, doc_curr_code FROM combos
           GROUP BY ALL HAVING count(*) = 1),
    c2 AS (SELECT purchase_vendor_id, plant_code, material_id, doc_curr_code FROM combos
           GROUP BY ALL HAVING count(*) > 1),
    c3 AS (SELECT purchase_vendor_id, plant_code, material_id, price_unit_factor FROM combos
           GROUP BY ALL HAVING count(*) > 1),
    cases AS (
        SELECT f.* FROM priced f JOIN c1 c ON f.purchase_vendor_id = c.purchase_vendor_id
          AND f.plant_code = c.plant_code AND f.material_id = c.material_id
        UNION ALL
        SELECT f.* REPLACE (1 AS price_unit_factor) FROM priced f
        JOIN c2 c ON f.purchase_vendor_id = c.purchase_vendor_id
          AND f.plant_code = c.plant_code AND f.material_id = c.material_id),
    kept AS (SELECT v.* FROM cases v ANTI JOIN c3 c
          ON v.purchase_vendor_id = c.purchase_vendor_id
          AND v.plant_code = c.plant_code AND v.material_id = c.material_id)"""


@query("harmonise_price_lines", f"""
    WITH priced AS (SELECT purchase_vendor_id, plant_code, material_id, price_unit_factor, doc_curr_code, price_purch_rate
                    FROM {{price_line}}), {_PRICE_CASES} SELECT * FROM kept""")
def _(f):
    lines = f.price_line.select("purchase_vendor_id", "plant_code", "material_id",
                                "price_unit_factor", "doc_curr_code", "price_purch_rate")
    return P.harmonise_price_lines(lines)


@query("average_prices", f"""
    WITH priced AS (SELECT * FROM {{price_line}}), {_PRICE_CASES}
    SELECT purchase_vendor_id, plant_code, material_id, price_unit_factor, doc_curr_code,
           {R('avg(price_purch_rate)')} AS price_purch_rate,
           {R('avg(price_purch_rate_usd)')} AS price_purch_rate_usd,
           {R('avg(mm_minimum_lot_size)')} AS mm_minimum_lot_size,
           {R('avg(mm_minimum_lot_size_dfc)')} AS mm_minimum_lot_size_dfc,
           {R('avg(avg_batch_consumption_qty)')} AS avg_batch_consumption_qty
    FROM kept GROUP BY purchase_vendor_id, plant_code, material_id, price_unit_factor,
                       doc_curr_code""")
def _(f):
    keys = [*PAIR, "price_unit_factor", "doc_curr_code"]
    means = P.average_prices(P.harmonise_price_lines(f.price_line), keys)
    return means.select(*keys, *[rounded(c).alias(c) for c in P.PRICE_MEASURES])


SPEND = "price_purch_rate_usd / price_unit_factor * qty_forecast_n12"


@query("spend_and_share", f"""
    WITH spent AS (
        SELECT ticket_custom_id, abc_mat_fam_new_msm, sum({SPEND}) AS spend
        FROM {{line}} GROUP BY ticket_custom_id, abc_mat_fam_new_msm)
    SELECT ticket_custom_id, abc_mat_fam_new_msm, {R('spend', 2)} AS total_family_spend,
           {R('sum(spend) OVER (PARTITION BY ticket_custom_id)', 2)} AS total_ticket_spend,
           {R('spend / sum(spend) OVER (PARTITION BY ticket_custom_id) * 100', 2)} AS percentage,
           CAST(trunc(spend) AS BIGINT) AS annual_fcst_consumption_fam
    FROM spent""")
def _(f):
    shares = K.spend_and_share(f.line.withColumn("spend_material_current", K.spend()))
    return shares.withColumns({c: rounded(c, 2) for c in ("total_family_spend",
                                                          "total_ticket_spend", "percentage")})


@query("family_indicators", """
    SELECT material_id, plant_code, ticket_id, abc_mat_fam_name,
           CASE WHEN CAST(material_id AS BIGINT) = TRY_CAST(abc_mat_fam_name AS BIGINT)
                THEN 'No' ELSE 'Yes' END AS current_prod_fam_ind,
           CASE WHEN CAST(material_id AS BIGINT) = TRY_CAST(abc_mat_fam_new_msm AS BIGINT)
                THEN 'No' ELSE 'Yes' END AS future_prod_fam_ind
    FROM {line}""")
def _(f):
    return K.family_indicators(f.line).select("material_id", "plant_code", "ticket_id",
                                              "abc_mat_fam_name", "current_prod_fam_ind",
                                              "future_prod_fam_ind")


FAMILY_FORECAST = """
    forecast AS (
        SELECT *, CASE WHEN CAST(material_id AS BIGINT) = TRY_CAST(abc_mat_fam_name AS BIGINT)
                       THEN qty_forecast_n12
                       ELSE sum(qty_forecast_n12) OVER (PARTITION BY ticket_id, abc_mat_fam_name)
                  END AS family_total
        FROM {line})"""


@query("family_forecast", f"""
    WITH {FAMILY_FORECAST}
    SELECT ticket_id, abc_mat_fam_name, material_id, plant_code, purchase_vendor_id,
           qty_forecast_n12, family_total AS annual_fcst_cons_current FROM forecast""")
def _(f):
    df = K.family_forecast(K.family_indicators(f.line.drop("annual_fcst_cons_current")))
    return df.select("ticket_id", "abc_mat_fam_name", "material_id", "plant_code",
                     "purchase_vendor_id", "qty_forecast_n12", "annual_fcst_cons_current")


@query("annual_runs", f"""
    WITH {FAMILY_FORECAST}
    SELECT ticket_id, material_id, plant_code, purchase_vendor_id, qty_forecast_n12,
           {R('family_total / nullif(min_prod_qty - 20, 0)', 1)} AS current_annual_runs
    FROM forecast""")
def _(f):
    zeros = f.line.drop("annual_fcst_cons_current").withColumn(
        "min_prod_qty", F.col("min_prod_qty") - 20)
    df = K.annual_runs(K.family_forecast(K.family_indicators(zeros)))
    return df.select("ticket_id", "material_id", "plant_code", "purchase_vendor_id",
                     "qty_forecast_n12", rounded("current_annual_runs", 1)
                     .alias("current_annual_runs"))


CLASSES = f"""
    spent AS (
        SELECT ticket_custom_id, abc_mat_fam_new_msm, sum({SPEND}) AS spend
        FROM {{line}} GROUP BY ticket_custom_id, abc_mat_fam_new_msm),
    shares AS (
        SELECT ticket_custom_id, abc_mat_fam_new_msm,
               {R('spend / sum(spend) OVER (PARTITION BY ticket_custom_id) * 100', 2)}
                   AS percentage
        FROM spent),
    ranked AS (
        SELECT *, {R('''sum(percentage) OVER (PARTITION BY ticket_custom_id
                        ORDER BY percentage DESC, abc_mat_fam_new_msm
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)''', 2)} AS accumulated
        FROM shares),
    classes AS (
        SELECT *, CASE WHEN accumulated <= 80 THEN 'A' WHEN accumulated <= 95 THEN 'B' ELSE 'C' END
                   AS abc_segment
        FROM ranked)"""


def _classes(f):
    shares = K.spend_and_share(f.line.withColumn("spend_material_current", K.spend()))
    return K.abc_classify(
        shares.select("ticket_custom_id", "abc_mat_fam_new_msm", "percentage"))


@query("abc_classify", f"WITH {CLASSES} SELECT * FROM classes")
def _(f):
    return _classes(f)


# Every customer is an item, so most shares round to zero and one group holds a fifth of them.
@query("abc_classify_many_items", f"""
    WITH spent AS (
        SELECT c_mktsegment, o_custkey, sum(o_totalprice) AS spend
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment, o_custkey),
    shares AS (
        SELECT c_mktsegment, o_custkey,
               {R('spend / sum(spend) OVER (PARTITION BY c_mktsegment) * 100', 2)} AS percentage
        FROM spent),
    ranked AS (
        SELECT *, {R('''sum(percentage) OVER (PARTITION BY c_mktsegment
                        ORDER BY percentage DESC, o_custkey
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)''', 2)} AS accumulated
        FROM shares)
    SELECT *, CASE WHEN accumulated <= 80 THEN 'A' WHEN accumulated <= 95 THEN 'B' ELSE 'C' END
               AS abc_segment
    FROM ranked""")
def _(f):
    spent = f.orders.select("o_custkey", "o_totalprice").join(
        f.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    shares = K.spend_and_share(spent, "c_mktsegment", "o_custkey", "o_totalprice")
    return K.abc_classify(shares.select("c_mktsegment", "o_custkey", "percentage"),
                          "c_mktsegment", "o_custkey")


@query("attach_classes", f"""
    WITH {CLASSES}
    SELECT l.ticket_custom_id, l.material_id, l.plant_code, l.purchase_vendor_id,
           l.qty_forecast_n12, c.percentage AS family_percentage,
           c.accumulated AS ticket_accumulated, c.abc_segment
    FROM {{line}} l LEFT JOIN classes c ON l.ticket_custom_id = c.ticket_custom_id
      AND l.abc_mat_fam_new_msm = c.abc_mat_fam_new_msm""")
def _(f):
    return K.attach_classes(f.line.drop("abc_segment"), _classes(f)).select(
        "ticket_custom_id", "material_id", "plant_code", "purchase_vendor_id",
        "qty_forecast_n12", "family_percentage", "ticket_accumulated", "abc_segment")


@query("segment_weighted_runs", f"""
    WITH runs AS (
        SELECT *, round(price_purch_rate_usd / min_prod_qty, 1) AS runs,
               sum(qty_forecast_n12) OVER (PARTITION BY ticket_custom_id, abc_segment) AS total
        FROM {{line}})
    SELECT ticket_custom_id, material_id, plant_code, purchase_vendor_id, abc_segment,
           qty_forecast_n12,
           {R('price_purch_rate_usd * qty_forecast_n12 / total', 1)} AS current_annual_runs_weighted
    FROM runs""")
def _(f):
    df = K.segment_weighted_runs(f.line.withColumn("current_annual_runs",
                                                   F.col("price_purch_rate_usd")))
    return df.select("ticket_custom_id", "material_id", "plant_code", "purchase_vendor_id",
                     "abc_segment", "qty_forecast_n12", "current_annual_runs_weighted")


@query("ticket_qc", """
    SELECT ticket_custom_id, count(*) AS total_rows,
           count(DISTINCT abc_mat_fam_new_msm) AS distinct_fam
    FROM {line} GROUP BY ticket_custom_id""")
def _(f):
    return K.ticket_qc(f.line)
