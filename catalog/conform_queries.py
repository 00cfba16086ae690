"""Ingest and conform operators over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.domain import AS_OF, PLANT, TICKET, VENDOR
from catalog.registry import R, query, rounded
from lotcraft.operators import conform as C
from lotcraft.operators.planning import consumption_within_days, padded_overrides
from lotcraft.sources import (
    cut_lineage,
    export_csv_chunks,
    load_csv_dir,
    publish,
    read_merged_parquet,
    read_pipe_csv,
)
from lotcraft.sources.readers import text_schema
from lotcraft.sources.staging import new_folder

OWNERS = ("user3@example.com", "owner3@example.com")
VENDORS = ("%11%",)
OWNER_LIST = "('user3@example.com', 'owner3@example.com')"


def _write_pipe_csv(df, path):
    (
        df.write.option("sep", "|").option("header", True).option("quoteAll", True)
        .option("escape", '"').option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    )


@query("read_pipe_csv", """
    SELECT CAST(doc_id AS STRING) AS doc_id, text, lang, CAST(n_chars AS STRING) AS n_chars
    FROM documents""")
def _(f):
    path = new_folder(f.spark, "extract")
    _write_pipe_csv(f.documents.select("doc_id", "text", "lang", "n_chars"), path)
    return read_pipe_csv(f.spark, path, text_schema(["doc_id", "text", "lang", "n_chars"]))


@query("sanitize_columns", """
    SELECT doc_id, n_chars AS n_chars_x_, lang AS langab, source AS sourcer FROM documents""")
def _(f):
    odd = f.documents.select("doc_id", "n_chars", "lang", "source").toDF(
        "doc id", "n,chars[x]", "lang.(a)-b", "source\\rr"
    )
    return C.sanitize_columns(odd)


@query("zero_pad", """
    SELECT o_orderkey, right('00000000' || CAST(o_custkey AS STRING), 8) AS wide,
           right('000' || CAST(o_orderkey AS STRING), 3) AS keep_right,
           lpad(CAST(o_orderkey AS STRING), 3, '0') AS keep_left
    FROM orders""")
def _(f):
    keyed = f.orders.select(
        "o_orderkey", F.col("o_custkey").alias("wide"), F.col("o_orderkey").alias("keep_right"),
        F.col("o_orderkey").alias("keep_left"),
    )
    padded = C.zero_pad(keyed, {"wide": 8, "keep_right": 3})
    return C.zero_pad(padded, {"keep_left": 3}, keep="left")


@query("cast_columns", """
    SELECT ticket_id, plant_code, vendor_id,
           CAST(TRY_CAST(min_prod_qty AS DECIMAL(10,2)) AS DOUBLE) AS min_prod_qty,
           CAST(TRY_CAST(setup_cost_usd AS DECIMAL(10,2)) AS DOUBLE) AS setup_cost_usd,
           TRY_CAST(prod_rounding_value AS INT) AS prod_rounding_value,
           CAST(trunc(TRY_CAST(qty_forecast_n12 AS DOUBLE)) AS INT) AS qty_forecast_n12
    FROM {input_raw}""")
def _(f):
    typed = C.cast_columns(
        f.input_raw.select("ticket_id", "plant_code", "vendor_id", "min_prod_qty",
                           "setup_cost_usd", "prod_rounding_value", "qty_forecast_n12"),
        {"min_prod_qty": "decimal(10,2)", "setup_cost_usd": "decimal(10,2)",
         "prod_rounding_value": "int", "qty_forecast_n12": "int", "plant_code": "varchar(4)"},
    )
    return typed.withColumns({c: F.col(c).cast("double")
                              for c in ("min_prod_qty", "setup_cost_usd")})


@query("exclude_test_rows", f"""
    SELECT i.ticket_id, material_id, plant_code, abc_mat_fam_new, ticket_owner, t.vendor_id
    FROM {{input_raw}} i JOIN {{trigger_raw}} t ON i.ticket_id = t.ticket_id
    WHERE ticket_owner NOT IN {OWNER_LIST} AND t.vendor_id NOT LIKE '%11%'
      AND (abc_mat_fam_new NOT LIKE '%test%' OR abc_mat_fam_new IS NULL)""")
def _(f):
    rows = f.input_raw.select("ticket_id", "material_id", "plant_code", "abc_mat_fam_new").join(
        f.trigger_raw.select("ticket_id", "ticket_owner", "vendor_id"), "ticket_id"
    )
    return C.exclude_test_rows(rows, OWNERS, VENDORS, family_col="abc_mat_fam_new")


@query("conform_trigger_summary", f"""
    SELECT right('0000000000' || vendor_id, 10) AS vendor_id, ticket_id, ticket_owner,
           TRY_CAST(supplier_holding_period AS INT) AS supplier_holding_period,
           TRY_CAST(pipo_horizon_days AS INT) AS pipo_horizon_days,
           TRY_CAST(pallet_qty AS BIGINT) AS pallet_qty,
           CAST(TRY_CAST(warehouse_per_pallet_amt_usd AS DECIMAL(18,3)) AS DOUBLE)
               AS warehouse_per_pallet_amt_usd,
           CAST(TRY_CAST(warehouse_pallet_stacking_factor AS DECIMAL(18,3)) AS DOUBLE)
               AS warehouse_pallet_stacking_factor,
           coalesce(commercial_transparency_type,
                    CASE commercial_transparency_flag WHEN 'yes' THEN 'price scale'
                         WHEN 'no' THEN 'single pricing' END) AS commercial_transparency_type
    FROM {{trigger_raw}}
    WHERE ticket_owner NOT IN {OWNER_LIST} AND vendor_id NOT LIKE '%11%'""")
def _(f):
    return C.conform_trigger_summary(f.trigger_raw, OWNERS, VENDORS).select(
        "vendor_id", "ticket_id", "ticket_owner", "supplier_holding_period", "pipo_horizon_days",
        "pallet_qty", F.col("warehouse_per_pallet_amt_usd").cast("double")
        .alias("warehouse_per_pallet_amt_usd"),
        F.col("warehouse_pallet_stacking_factor").cast("double")
        .alias("warehouse_pallet_stacking_factor"), "commercial_transparency_type",
    )


@query("conform_inprocess_input", f"""
    SELECT right('0000000000' || i.vendor_id, 10) AS vendor_id,
           right('0000' || plant_code, 4) AS plant_code,
           right('000000000000000000' || material_id, 18) AS material_id, i.ticket_id,
           CAST(TRY_CAST(min_prod_qty AS DECIMAL(12,2)) AS DOUBLE) AS min_prod_qty,
           abc_mat_fam_new
    FROM {{input_raw}} i JOIN {{trigger_raw}} t ON i.ticket_id = t.ticket_id
    WHERE trim(material_id) <> '' AND ticket_owner NOT IN {OWNER_LIST}
      AND abc_mat_fam_new NOT LIKE '%test%' AND i.vendor_id NOT LIKE '%11%'""")
def _(f):
    raw = f.input_raw.withColumnRenamed("vendor_id", "vendor_code")
    return C.conform_inprocess_input(raw, f.trigger_raw, OWNERS, VENDORS).select(
        "vendor_id", "plant_code", "material_id", "ticket_id",
        F.col("min_prod_qty").cast("double").alias("min_prod_qty"), "abc_mat_fam_new",
    )


@query("conform_supplier_input", f"""
    WITH typed AS (
        SELECT right('0000000000' || vendor_id, 10) AS vendor_id,
               upper(right('0000' || plant_code, 4)) AS plant_code,
               right('000000000000000000' || material_id, 18) AS material_id, ticket_id,
               upper(coalesce(abc_mat_fam_name, right('000000000000000000' || material_id, 18)))
                   AS abc_mat_fam_name, abc_mat_fam_new,
               CAST(TRY_CAST(setup_cost_usd AS DECIMAL(10,2)) AS DOUBLE) AS setup_cost_usd,
               CAST(CAST(coalesce(vendor_plant_change_freq, '0') AS DECIMAL(10,2)) AS DOUBLE)
                   AS vendor_plant_change_freq
        FROM {{input_raw}} WHERE trim(material_id) <> ''),
    counted AS (
        SELECT *, count(*) OVER (PARTITION BY material_id, plant_code, vendor_id, ticket_id)
                   AS supplier_input_repeats
        FROM typed)
    SELECT c.* FROM counted c JOIN {{trigger_raw}} t ON c.ticket_id = t.ticket_id
    WHERE ticket_owner NOT IN {OWNER_LIST} AND c.vendor_id NOT LIKE '%11%'
      AND (abc_mat_fam_new NOT LIKE '%test%' OR abc_mat_fam_new IS NULL)""")
def _(f):
    return C.conform_supplier_input(f.input_raw, f.trigger_raw, OWNERS, VENDORS).select(
        "vendor_id", "plant_code", "material_id", "ticket_id", "abc_mat_fam_name",
        "abc_mat_fam_new", F.col("setup_cost_usd").cast("double").alias("setup_cost_usd"),
        F.col("vendor_plant_change_freq").cast("double").alias("vendor_plant_change_freq"),
        "supplier_input_repeats",
    )


@query("resolve_price_scale", f"""
    WITH rows AS (
        SELECT right('0000000000' || vendor_id, 10) AS vendor_id,
               right('0000' || plant_code, 4) AS plant_code,
               right('000000000000000000' || material_id, 18) AS material_id, scale_fam,
               TRY_CAST(mpq_scale_qty AS DECIMAL(12,2)) AS mpq_scale_qty,
               TRY_CAST(scale_price AS DECIMAL(12,2)) AS scale_price, doc_curr_code,
               valid_start_date, ticket_id,
               trim(material_id) <> '' AS has_material, trim(scale_fam) <> '' AS has_family
        FROM {{scale_raw}})
    SELECT DISTINCT r.vendor_id, upper(r.plant_code) AS plant_code,
           coalesce(r.material_id, si.material_id) AS material_id, scale_fam,
           CAST(mpq_scale_qty AS DOUBLE) AS mpq_scale_qty,
           CAST(scale_price AS DOUBLE) AS scale_price, doc_curr_code, valid_start_date,
           r.ticket_id, scale_scenario_type
    FROM rows r JOIN {{scale_summary}} s ON r.ticket_id = s.ticket_id
         JOIN {{input}} si ON si.ticket_id = s.supplier_input_ticket_id
          AND CASE WHEN scale_scenario_type = '1' THEN r.material_id ELSE r.scale_fam END
            = CASE WHEN scale_scenario_type = '1' THEN si.material_id
                   ELSE si.price_scale_fam_name END
    WHERE ticket_owner NOT IN {OWNER_LIST}
      AND (scale_scenario_type = '1' AND has_material OR scale_scenario_type = '2' AND has_family)
    """)
def _(f):
    return C.resolve_price_scale(f.scale_raw, f.scale_summary, f.input, OWNERS).select(
        "vendor_id", "plant_code", "material_id", "scale_fam",
        F.col("mpq_scale_qty").cast("double").alias("mpq_scale_qty"),
        F.col("scale_price").cast("double").alias("scale_price"), "doc_curr_code",
        "valid_start_date", "ticket_id", "scale_scenario_type",
    )


_QUOTED = ["qty_forecast_n12_family", "freight_factor", "min_prod_qty_sc1", "runs_annual_sc4",
           "net_price_sc8"]


def _quoted_sql(extra: str, condition: str, plant: str) -> str:
    quoted = ", ".join(f"CAST(TRY_CAST({c} AS DECIMAL(12,2)) AS DOUBLE) AS {c}" for c in _QUOTED)
    return f"""
    SELECT right('0000000000' || q.vendor_id, 10) AS vendor_id, {plant} AS plant_code, {extra}
           abc_mat_fam_new_msm, TRY_CAST(price_unit_factor AS INT) AS price_unit_factor, {quoted},
           q.ticket_id
    FROM {{quotation_raw}} q JOIN {{quotation_summary}} s ON q.ticket_id = s.ticket_id
    WHERE ticket_owner NOT IN {OWNER_LIST} AND q.vendor_id NOT LIKE '%11%' {condition}"""


def _quoted(df, extra=()):
    return df.select("vendor_id", "plant_code", *extra, "abc_mat_fam_new_msm",
                     "price_unit_factor", *[F.col(c).cast("double").alias(c) for c in _QUOTED],
                     "ticket_id")


@query("conform_quotation", _quoted_sql(
    "right('000000000000000000' || material_id, 18) AS material_id,", "",
    "upper(right('0000' || plant_code, 4))"))
def _(f):
    df = C.conform_quotation(f.quotation_raw, f.quotation_summary, False, OWNERS, VENDORS)
    return _quoted(df, ["material_id"])


@query("conform_family_quotation", _quoted_sql(
    "", "AND trim(abc_mat_fam_new_msm) <> ''", "right('0000' || plant_code, 4)"))
def _(f):
    raw = f.quotation_raw.drop("material_id", "qty_forecast_n12")
    return _quoted(C.conform_quotation(raw, f.quotation_summary, True, OWNERS, VENDORS))


@query("conform_scale_summary", f"""
    SELECT right('0000000000' || vendor_id, 10) AS vendor_id, ticket_id, supplier_input_ticket_id,
           ticket_owner, scale_scenario_type, supplier_deadline, ticket_status
    FROM {{scale_summary}} WHERE ticket_owner NOT IN {OWNER_LIST}""")
def _(f):
    return C.conform_scale_summary(f.scale_summary, OWNERS).select(
        "vendor_id", "ticket_id", "supplier_input_ticket_id", "ticket_owner",
        "scale_scenario_type", "supplier_deadline", "ticket_status",
    )


@query("conform_quotation_summary", f"""
    SELECT right('0000000000' || vendor_id, 10) AS vendor_id, ticket_id, ticket_owner,
           TRY_CAST(quotation_scenario_type AS INT) AS quotation_scenario_type, ticket_status
    FROM {{quotation_summary}}
    WHERE ticket_owner NOT IN {OWNER_LIST} AND vendor_id NOT LIKE '%11%'""")
def _(f):
    return C.conform_quotation_summary(f.quotation_summary, OWNERS, VENDORS).select(
        "vendor_id", "ticket_id", "ticket_owner", "quotation_scenario_type", "ticket_status"
    )


def _family_quotation(f):
    """The frame of that name, made distinct by what its 30 columns are computed from."""
    rows = f.lineitem.join(f.part, F.col("l_partkey") == F.col("p_partkey")).selectExpr(
        f"{VENDOR} AS vendor_id", f"{PLANT} AS plant_code", "p_brand", "p_size", "p_retailprice",
        f"{TICKET} AS ticket_id",
    ).distinct()
    measures = [F.expr(m) for n in range(1, 9) for m in (
        f"CAST({n} * p_size AS DOUBLE) AS min_prod_qty_sc{n}",
        f"CAST({n} AS DOUBLE) AS runs_annual_sc{n}",
        f"CAST(p_retailprice AS DOUBLE) AS net_price_sc{n}")]
    return rows.select(
        "vendor_id", "plant_code", F.col("p_brand").alias("abc_mat_fam_new_msm"),
        *[F.expr(e) for e in (
            "'EA' AS base_unit_of_measure", "CAST(p_size AS DOUBLE) AS qty_forecast_n12_family",
            "'A' AS abc_segment", "0.5 AS freight_factor", "'No' AS flag_supplier_inv_storage",
            "100 AS price_unit_factor", "'USD' AS doc_curr_code")],
        *measures, "ticket_id",
    )


@query("expand_family_quotation", f"""
    WITH used AS (
        SELECT material_id, plant_code, sum(sum_total_requirement_qty) AS total_requirement_qty
        FROM {{consumption}} WHERE requirement_date_for_the_component <= '19990101'
        GROUP BY material_id, plant_code),
    members AS (SELECT DISTINCT ticket_id, vendor_id, plant_code, abc_mat_fam_new_msm, material_id
                FROM {{input}}),
    given AS (SELECT lpad(vendor_id, 10, '0') AS vendor_id, lpad(plant_code, 4, '0') AS plant_code,
                     lpad(material_id, 18, '0') AS material_id, ticket_id, qty_forecast_override
              FROM {{override}})
    SELECT right('0000000000' || q.vendor_id, 10) AS vendor_id,
           upper(right('0000' || plant_code, 4)) AS plant_code,
           right('000000000000000000' || material_id, 18) AS material_id, abc_mat_fam_new_msm,
           CAST(TRY_CAST(qty_forecast_n12 AS DECIMAL(12,2)) AS DOUBLE) AS qty_forecast_n12,
           CAST(TRY_CAST(min_prod_qty_sc2 AS DECIMAL(12,2)) AS DOUBLE) AS min_prod_qty_sc2,
           q.ticket_id
    FROM {{quotation_raw}} q JOIN {{quotation_summary}} s ON q.ticket_id = s.ticket_id
    WHERE quotation_scenario_type = '1'
    UNION ALL
    SELECT q.vendor_id, q.plant_code, m.material_id, q.abc_mat_fam_new_msm,
           {R("CASE WHEN t.forecast_override_flag = 'yes' AND g.qty_forecast_override IS NOT NULL "
              "THEN g.qty_forecast_override ELSE u.total_requirement_qty END", 2)},
           q.min_prod_qty_sc2, q.ticket_id
    FROM {{family_quotation}} q
    JOIN {{quotation_summary}} s ON q.ticket_id = s.ticket_id
    LEFT JOIN members m ON m.ticket_id = s.supplier_input_ticket_id AND m.plant_code = q.plant_code
      AND m.vendor_id = q.vendor_id AND m.abc_mat_fam_new_msm = q.abc_mat_fam_new_msm
    LEFT JOIN {{ticket}} t ON t.ticket_id = s.supplier_input_ticket_id AND t.vendor_id = q.vendor_id
    LEFT JOIN used u ON u.plant_code = q.plant_code AND u.material_id = m.material_id
    LEFT JOIN given g ON g.vendor_id = q.vendor_id AND g.plant_code = q.plant_code
      AND g.material_id = m.material_id AND g.ticket_id = s.supplier_input_ticket_id
    WHERE quotation_scenario_type = '2'""")
def _(f):
    summary = C.conform_quotation_summary(f.quotation_summary)
    quoted = _family_quotation(f)
    used = consumption_within_days(f.consumption, ["material_id", "plant_code"], 365, AS_OF)
    df = C.expand_family_quotation(
        C.conform_quotation(f.quotation_raw, summary), quoted, summary, f.input,
        f.ticket, used, padded_overrides(f.override),
    )
    return df.select("vendor_id", "plant_code", "material_id", "abc_mat_fam_new_msm",
                     rounded("qty_forecast_n12", 2).alias("qty_forecast_n12"),
                     F.col("min_prod_qty_sc2").cast("double").alias("min_prod_qty_sc2"),
                     "ticket_id")


@query("conform_forecast_override", f"""
    SELECT right('0000000000' || o.vendor_id, 10) AS vendor_id,
           right('0000' || plant_code, 4) AS plant_code,
           right('000000000000000000' || material_id, 18) AS material_id,
           CAST(TRY_CAST(qty_forecast_override AS DECIMAL(12,2)) AS DOUBLE)
               AS qty_forecast_override, o.ticket_id
    FROM {{override}} o JOIN {{ticket}} t ON t.ticket_id = o.ticket_id
    WHERE ticket_owner NOT IN {OWNER_LIST} AND o.vendor_id NOT LIKE '%11%'""")
def _(f):
    raw = f.override.select("*", *[F.lit(None).cast("string").alias(c) for c in (
        "base_unit_of_measure", "net_price_rate_override", "doc_curr_code_override",
        "price_unit_factor_override", "qty_forecast_n1y")])
    return C.conform_forecast_override(raw, f.ticket, OWNERS, VENDORS).select(
        "vendor_id", "plant_code", "material_id",
        F.col("qty_forecast_override").cast("double").alias("qty_forecast_override"), "ticket_id",
    )


@query("publish", """
    SELECT source_system_code, count(*) AS n_rows, sum(CAST(mm_minimum_lot_size AS DOUBLE)) AS lots
    FROM {fact} GROUP BY source_system_code""")
def _(f):
    path = new_folder(f.spark, "published")
    publish(f.fact, path, partition_by=["source_system_code"])
    back = f.spark.read.parquet(path)
    return back.groupBy("source_system_code").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("mm_minimum_lot_size").cast("double"))
        .alias("lots"),
    )


@query("load_csv_dir", """
    SELECT 'conversations' AS table_name, count(*) AS n_rows, 
           CAST(sum(length(text)) AS BIGINT) AS text_chars, CAST(sum(turn) AS BIGINT) AS numbers
    FROM conversations
    UNION ALL SELECT 'documents', count(*), CAST(sum(length(text)) AS BIGINT),
           CAST(sum(n_chars) AS BIGINT) FROM documents""")
def _(f):
    path = new_folder(f.spark, "extracts")
    _write_pipe_csv(f.documents.select("text", F.col("n_chars").alias("number")),
                    f"{path}/documents.csv")
    _write_pipe_csv(f.conversations.select("text", F.col("turn").alias("number")),
                    f"{path}/conversations.csv")
    types = {n: {"number": "bigint"} for n in ("documents", "conversations")}
    tables = load_csv_dir(f.spark, path, types)
    parts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
               F.sum(F.length("text")).alias("text_chars"), F.sum("number").alias("numbers"))
        for name, df in sorted(tables.items())
    ]
    return parts[0].unionByName(parts[1])


@query("export_csv_chunks", """
    SELECT vendor_id, plant_code, material_id, CAST(mpq_scale_qty AS STRING) AS mpq_scale_qty
    FROM {scale_fact}""")
def _(f):
    path = new_folder(f.spark, "export")
    rows = f.scale_fact.select("vendor_id", "plant_code", "material_id", "mpq_scale_qty")
    export_csv_chunks(rows, path, rows=10_000)
    return f.spark.read.option("header", True).schema(
        text_schema(["vendor_id", "plant_code", "material_id", "mpq_scale_qty"])
    ).csv(path)


@query("read_merged_parquet", """
    SELECT doc_id, lang, NULL::BIGINT AS n_chars FROM documents
    UNION ALL SELECT doc_id, NULL, n_chars FROM documents""")
def _(f):
    path = new_folder(f.spark, "merged")
    f.documents.select("doc_id", "lang").write.parquet(f"{path}/part=1")
    f.documents.select("doc_id", "n_chars").write.parquet(f"{path}/part=2")
    return read_merged_parquet(f.spark, path).drop("part")


@query("cut_lineage", """
    SELECT plant_code, count(*) AS n_rows FROM {fact} GROUP BY plant_code""")
def _(f):
    return cut_lineage(f.fact).groupBy("plant_code").agg(F.count(F.lit(1)).alias("n_rows"))
