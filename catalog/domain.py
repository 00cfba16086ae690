"""The test tables seen as procurement tables.

Every frame covers its source tables whole. The text is plain SQL that Spark and DuckDB
both read; a name in braces is a test table or another frame of this module.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession

from lotcraft.session import configure

AS_OF = dt.date(1998, 1, 1)

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def _id(column: str, width: int) -> str:
    text = f"CAST({column} AS STRING)"
    return f"lpad({text}, CAST(greatest({width}, length({text})) AS INT), '0')"


def _day(column: str) -> str:
    return f"replace(CAST(CAST({column} AS DATE) AS STRING), '-', '')"


VENDOR, PLANT = _id("l_suppkey", 10), _id("l_linenumber", 4)
MATERIAL, TICKET = _id("l_partkey", 18), _id("l_orderkey", 7)
TYPE = "CASE l_partkey % 3 WHEN 0 THEN 'ROH' WHEN 1 THEN 'HALB' ELSE 'FERT' END"
SYSTEM = "CASE l_returnflag WHEN 'A' THEN 'ABC100' WHEN 'N' THEN 'DEF200' ELSE 'GHI300' END"
CURRENCY = "CASE l_linestatus WHEN 'F' THEN 'USD' ELSE 'EUR' END"
FACTOR = "CASE WHEN l_tax < 0.03 THEN 1 WHEN l_tax < 0.06 THEN 100 ELSE 1000 END"
def _scenarios(text: bool = True) -> str:
    """The 24 quoted measures, scenario by scenario."""
    kind = "STRING" if text else "DOUBLE"
    return ", ".join(
        f"CAST({n} * p_size AS {kind}) AS min_prod_qty_sc{n}, "
        f"CAST({n} AS {kind}) AS runs_annual_sc{n}, "
        f"CAST(p_retailprice AS {kind}) AS net_price_sc{n}"
        for n in range(1, 9)
    )


NATURAL = " || '-' || ".join(
    f"CAST({c} AS STRING)" for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
)

DOMAIN = {
    "consumption": f"""
        SELECT {MATERIAL} AS material_id, {PLANT} AS plant_code, {VENDOR} AS purchase_vendor_id,
               {TYPE} AS material_type, {_day('l_shipdate')} AS requirement_date_for_the_component,
               l_quantity AS sum_total_requirement_qty
        FROM {{lineitem}}""",
    "agreement": f"""
        SELECT {NATURAL} AS agreement_naturalkey, {SYSTEM} AS source_system_code,
               {VENDOR} AS purchase_vendor_id, {PLANT} AS plant_code,
               'Plant ' || CAST(l_linenumber AS STRING) AS plant_name, {MATERIAL} AS material_id,
               p_name AS material_desc, {TYPE} AS material_type, {FACTOR} AS price_unit_factor,
               {CURRENCY} AS doc_curr_code, l_extendedprice AS net_price_rate,
               p_retailprice AS price_purch_usd, p_type AS spend_pool_lkp_code,
               p_type AS spend_pool_group, p_type AS spend_pool_medium_name,
               CASE WHEN p_size < 10 THEN 'PACKAGING' ELSE 'OTHER' END AS spend_pool_high_name,
               p_brand AS spend_pool_low_name, p_brand AS business_unit_lkp_code,
               p_type AS sector_business_unit, p_brand AS business_unit,
               CASE WHEN l_discount < 0.075 THEN 'Y' ELSE 'N' END AS source_list_flag,
               {_day('l_shipdate')} AS valid_end_date,
               CASE WHEN p_size < 25 THEN 'EA' ELSE 'KG' END AS base_uom,
               CASE WHEN p_size < 25 THEN 'EA' ELSE 'KG' END AS order_uom,
               CAST(l_orderkey AS STRING) AS purchase_doc_num,
               CAST(l_linenumber AS STRING) AS purchase_doc_line_num,
               l_linestatus AS purchase_doc_type_desc
        FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey""",
    "plan": f"""
        SELECT {NATURAL} AS agreement_naturalkey, {VENDOR} AS purchase_vendor_id,
               s_name AS vendor_name, {MATERIAL} AS material_id, p_name AS material_desc,
               {PLANT} AS plant_code, 'Plant ' || CAST(l_linenumber AS STRING) AS plant_name,
               l_quantity * 10 AS mm_minimum_lot_size, p_brand AS business_unit,
               CASE WHEN s_nationkey < 10 THEN 'GC' ELSE 'LA' END AS plant_region_override,
               {TICKET} AS ticket_id,
               'planner' || CAST(l_suppkey % 20 AS STRING) || '@example.com' AS ticket_owner,
               CAST(l_shipdate AS DATE) AS modified_date, {SYSTEM} AS source_system_code
        FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey
             JOIN {{supplier}} ON l_suppkey = s_suppkey""",
    "trigger_raw": f"""
        SELECT CAST(o_custkey % 100 AS STRING) AS vendor_id, {_id('o_orderkey', 7)} AS ticket_id,
               CAST(CAST(o_orderdate AS DATE) AS STRING) AS modified_date,
               CASE WHEN o_custkey % 50 = 9 THEN NULL
                    WHEN o_custkey % 50 = 7 THEN 'user7'
                    ELSE 'user' || CAST(o_custkey % 50 AS STRING) || '@example.com'
               END AS ticket_owner,
               CASE WHEN o_custkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS supplier_storage_flag,
               CAST(o_custkey % 40 AS STRING) AS supplier_holding_period,
               CASE o_orderstatus WHEN 'F' THEN 'yes' WHEN 'O' THEN 'no' END
                   AS commercial_transparency_flag,
               CASE WHEN o_custkey % 3 = 0 THEN 'yes' ELSE 'no' END AS production_families_flag,
               CASE WHEN o_orderkey % 3 = 0 THEN 'yes' ELSE 'no' END AS forecast_override_flag,
               'T-' || CAST(o_orderkey AS STRING) AS ticket_custom_id,
               o_orderpriority AS ticket_title,
               CASE o_orderstatus WHEN 'F' THEN 'Published'
                    WHEN 'O' THEN 'Awaiting for Supplier input' ELSE 'Draft' END AS ticket_status,
               CASE WHEN o_custkey % 9 = 0 THEN 'n/a' ELSE CAST(o_custkey % 365 AS STRING) END
                   AS pipo_horizon_days,
               CAST(o_custkey % 60 AS STRING) AS restriction_max_mpq_dfc,
               'yes' AS current_warehouse_flag, CAST(o_orderkey AS STRING) AS pallet_qty,
               CAST(o_totalprice AS STRING) AS warehouse_per_pallet_amt_usd,
               '1.25' AS transportation_per_pallet_amt_usd, 'no' AS external_warehouse_flag,
               CAST(o_custkey AS STRING) AS current_pallet_qty,
               '' AS warehouse_pallet_stacking_factor,
               CAST(CAST(o_orderdate AS DATE) AS STRING) AS supplier_deadline_date,
               CASE WHEN o_custkey % 11 = 0 THEN NULL
                    ELSE 'supplier' || CAST(o_custkey % 100 AS STRING) || '@example.com'
               END AS supplier_email,
               CASE WHEN o_orderkey % 2 = 0 THEN 'Yes' ELSE 'No' END
                   AS current_supplier_storage_flag,
               CASE WHEN o_orderkey % 5 = 0 THEN 'No' ELSE 'Yes' END
                   AS future_supplier_storage_flag,
               'buyer' || CAST(o_custkey % 10 AS STRING) || '@example.com' AS buyer_email,
               'no' AS current_price_override_flag,
               CASE WHEN o_custkey % 4 = 0 THEN 'cost based' END AS commercial_transparency_type,
               '12' AS supplier_holding_cost
        FROM {{orders}}""",
    "ticket": f"""
        SELECT {_id('o_custkey % 100', 10)} AS vendor_id, ticket_id, modified_date, ticket_owner,
               commercial_transparency_flag, forecast_override_flag, ticket_custom_id, ticket_title,
               ticket_status, o_custkey % 365 AS pipo_horizon_days, supplier_deadline_date,
               supplier_email, buyer_email, current_supplier_storage_flag,
               future_supplier_storage_flag
        FROM {{trigger_raw}} JOIN {{orders}} ON ticket_id = {_id('o_orderkey', 7)}""",
    "input_raw": f"""
        SELECT CAST(l_suppkey AS STRING) AS vendor_id, 'p' || CAST(l_linenumber AS STRING)
                   AS plant_code,
               CASE WHEN l_quantity = 1 THEN ' ' ELSE CAST(l_partkey AS STRING) END AS material_id,
               CAST(l_quantity * 12 AS STRING) AS qty_forecast_n12, 'EA' AS base_unit_of_measure,
               CAST(l_quantity AS STRING) AS mm_min_lot_size,
               CASE WHEN l_discount < 0.015 THEN 'n/a' ELSE CAST(l_quantity AS STRING) END
                   AS min_prod_qty,
               CASE WHEN l_tax < 0.015 THEN NULL ELSE 'fam ' || p_type END AS abc_mat_fam_name,
               CASE WHEN p_size = 7 THEN 'a test family' WHEN p_size = 8 THEN NULL ELSE p_brand END
                   AS abc_mat_fam_new,
               p_brand AS abc_mat_fam_new_msm, '10' AS restriction_min_prod_qty,
               CAST(l_quantity * 20 AS STRING) AS restriction_max_prod_qty,
               CAST(l_quantity AS STRING) AS material_per_pallet_qty,
               CAST(p_size AS STRING) AS material_shelf_life_months, 'PO' AS pipo_indicator,
               '' AS material_phase_out_phase_in, p_name AS initiative_name,
               p_type AS price_scale_fam_name, 'EA' AS supplier_uom, '1' AS supplier_uom_factor,
               {TICKET} AS ticket_id,
               CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(p_size AS STRING) END
                   AS vendor_plant_change_freq,
               CAST(l_linenumber AS STRING) AS pallet_stacking_factor,
               '10' AS prod_rounding_value, CAST(l_extendedprice AS STRING) AS setup_cost_usd
        FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey""",
    "input": f"""
        SELECT {VENDOR} AS vendor_id, {PLANT} AS plant_code, {MATERIAL} AS material_id,
               {TICKET} AS ticket_id, l_quantity AS min_prod_qty,
               'EA' AS base_uom, p_type AS abc_mat_fam_name, p_brand AS abc_mat_fam_new_msm,
               p_type AS price_scale_fam_name, 10 AS restriction_min_prod_qty,
               500 + p_size AS restriction_max_prod_qty, p_size AS material_per_pallet_qty,
               l_extendedprice AS setup_cost_usd, 10 AS prod_rounding_value,
               p_size AS material_shelf_life_months, 30 + p_size AS vendor_plant_change_freq,
               l_linenumber AS pallet_stacking_factor,
               CASE WHEN l_quantity < 3 THEN 2 ELSE 1 END AS supplier_input_repeats
        FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey""",
    "override": f"""
        SELECT CAST(l_suppkey AS STRING) AS vendor_id, CAST(l_linenumber AS STRING) AS plant_code,
               CAST(l_partkey AS STRING) AS material_id, {TICKET} AS ticket_id,
               CASE WHEN l_tax < 0.035 THEN NULL ELSE max(l_quantity) * 3 END
                   AS qty_forecast_override
        FROM {{lineitem}} GROUP BY l_suppkey, l_linenumber, l_partkey, l_orderkey, l_tax""",
    # Tickets over many materials: one per customer segment and vendor group.
    "line": f"""
        SELECT {_id('l_suppkey % 20', 7)} AS ticket_id,
               'T-' || CAST(l_suppkey % 20 AS STRING) AS ticket_custom_id,
               {SYSTEM} AS source_system_code, {VENDOR} AS purchase_vendor_id,
               {PLANT} AS plant_code, {MATERIAL} AS material_id, {CURRENCY} AS doc_curr_code,
               {FACTOR} AS price_unit_factor, p_retailprice AS price_purch_rate_usd,
               l_quantity AS qty_forecast_n12, l_quantity AS annual_fcst_cons_current,
               CASE WHEN p_size % 4 = 0 THEN CAST(p_partkey AS STRING) ELSE p_type END
                   AS abc_mat_fam_name,
               p_brand || '/' || CAST(p_size % 6 AS STRING) AS abc_mat_fam_new_msm,
               l_quantity * 2 AS min_prod_qty,
               10 + p_size % 7 AS restriction_min_prod_qty,
               400 + p_size AS restriction_max_prod_qty,
               CASE WHEN l_linenumber = 2 THEN NULL ELSE l_quantity + 5 END AS mm_minimum_lot_size,
               p_size AS material_per_pallet_qty, 5 + p_size % 3 * 5 AS prod_rounding_value,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE 100 + p_size END AS setup_cost_usd,
               0.08 AS nominal_wacc, 0.1 AS scrap_extra_charges,
               p_size AS material_shelf_life_months, 90 AS pipo_horizon_days,
               60 + p_size AS vendor_plant_change_freq,
               CASE WHEN p_size % 6 = 0 THEN 'No' ELSE 'Yes' END
                   AS future_flag_supplier_inv_storage,
               CASE WHEN p_size % 3 = 0 THEN 'A' WHEN p_size % 3 = 1 THEN 'B' ELSE 'C' END
                   AS abc_segment
        FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey""",
    "line_flag": f"""
        SELECT {_id('s_suppkey % 20', 7)} AS ticket_id,
               max(CASE WHEN s_suppkey % 2 = 0 THEN 'Yes' ELSE 'No' END)
                   AS current_supplier_storage_flag
        FROM {{supplier}} GROUP BY s_suppkey % 20""",
    "price_line": f"""
        SELECT {VENDOR} AS purchase_vendor_id, {PLANT} AS plant_code, {MATERIAL} AS material_id,
               {FACTOR} AS price_unit_factor,
               CASE WHEN l_discount < 0.035 THEN 'EUR' ELSE 'USD' END AS doc_curr_code,
               l_extendedprice AS price_purch_rate, l_quantity AS price_purch_rate_usd,
               l_quantity * 2 AS mm_minimum_lot_size, l_quantity AS mm_minimum_lot_size_dfc,
               l_tax AS avg_batch_consumption_qty, l_returnflag AS supplier_storage_flag
        FROM {{lineitem}}""",
    "initiative": f"""
        SELECT {_id('p_partkey', 18)} AS iopt_initiative_po_material_id,
               {_id('(p_partkey + 7) % 150', 18)} AS iopt_initiative_pi_material_id,
               {_id('p_size % 7 + 1', 4)} AS plant_code,
               p_name || ' #' || CAST(p_size AS STRING) AS iopt_initiative_name,
               CAST(l_ship AS STRING) AS iopt_initiative_sop_soq
        FROM {{part}} LEFT JOIN (
            SELECT l_partkey AS l_part, min(CAST(l_shipdate AS DATE)) AS l_ship
            FROM {{lineitem}} GROUP BY l_partkey) AS firsts ON p_partkey = l_part""",
    "storage": f"""
        SELECT {VENDOR} AS vendor_id, {MATERIAL} AS material_id,
               l_quantity AS storage_unit_quantity,
               CASE WHEN l_tax < 0.045 THEN 'Pallet' ELSE 'Box' END AS storage_unit_type
        FROM {{lineitem}}""",
    "plant": f"""
        SELECT {_id('n_nationkey', 4)} AS plant_code, n_name AS plant_name,
               {_id('n_nationkey', 4)} AS site_code, n_name AS country_code,
               'Region ' || CAST(n_regionkey AS STRING) AS prev_region_name
        FROM {{nation}}""",
    "geo": """
        SELECT n_name AS country_code, n_name AS country_name, r_name AS region_name,
               CASE r_name WHEN 'ASIA' THEN 'ASIA PACIFIC' WHEN 'AMERICA' THEN 'NORTH AMERICA'
                    WHEN 'AFRICA' THEN 'IMEA REGION' ELSE r_name END AS area
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "finance": """
        SELECT n_name AS country_code, n_nationkey / 100.0 AS nominal_wacc,
               n_regionkey / 10.0 AS scrap_extra_charges
        FROM {nation}""",
    "material": f"""
        SELECT CAST(p_partkey AS STRING) AS material_number, p_name AS material_desc,
               CASE WHEN p_size < 25 THEN 'EA' ELSE 'KG' END AS base_unit_of_measure,
               p_type AS material_group
        FROM {{part}}""",
    "material_padded": f"""
        SELECT {_id('p_partkey', 18)} AS material_number, p_name AS material_desc,
               p_type AS base_unit_of_measure
        FROM {{part}}""",
    "sync": f"""
        SELECT {_id('p_size % 7 + 1', 4)} AS plant_code, {_id('p_partkey', 18)} AS material_id,
               p_size AS batch_volume_uom, p_retailprice AS usage_uom, p_size AS weight,
               p_size AS cov_usage, p_size AS inventory, p_size AS sync
        FROM {{part}}""",
    "shelf": f"""
        SELECT {MATERIAL} AS material_id, {SYSTEM} AS source_system_code, {TYPE} AS material_type,
               CAST(floor(l_quantity) AS INT) % 6 AS calc_shelf_life
        FROM {{lineitem}}""",
    "lead_vendor": f"""
        SELECT {PLANT} AS plant_code, {MATERIAL} AS material_id,
               CASE WHEN l_discount < 0.055 THEN 1 ELSE 2 END AS itm_rank,
               {VENDOR} AS purchase_vendor_id
        FROM {{lineitem}}""",
    "change_freq": f"""
        SELECT {_id('p_size % 7 + 1', 4)} AS plant_code,
               {_id('p_partkey', 18)} AS iopt_initiative_pi_material_id,
               CAST(p_size % 4 AS STRING) AS change_frequency_times,
               CASE WHEN p_size % 9 = 0 THEN NULL ELSE p_size * 10 - 100 END
                   AS change_frequency_avg_days
        FROM {{part}}""",
    "production": f"""
        SELECT CAST(l_suppkey AS STRING) AS vendor_id, CAST(l_partkey AS STRING) AS material_id,
               max(l_quantity) AS min_prod_quantity, max(l_returnflag) AS production_family,
               'user' || CAST(l_suppkey % 30 AS STRING) || '@example.com' AS ticket_owner,
               'PA-' || CAST(l_suppkey AS STRING) AS ticket_custom_id
        FROM {{lineitem}} GROUP BY l_suppkey, l_partkey""",
    "unit": """
        SELECT p_brand AS code, CASE WHEN min(p_size) < 3 THEN 'core' ELSE 'other' END AS category
        FROM {part} GROUP BY p_brand""",
    "fact": f"""
        SELECT {VENDOR} AS purchase_vendor_id, {PLANT} AS plant_code, {MATERIAL} AS material_id,
               {SYSTEM} AS source_system_code, p_brand AS business_unit,
               p_brand AS business_unit_lkp_code, p_type AS spend_pool_low_name,
               CAST(l_quantity AS STRING) AS mm_minimum_lot_size,
               CASE WHEN l_quantity < 10 THEN NULL ELSE l_quantity END AS min_prod_qty,
               '10' AS restriction_min_prod_qty, '90' AS restriction_max_prod_qty,
               CAST(p_size AS STRING) AS material_per_pallet_qty,
               CASE WHEN l_tax < 0.025 THEN 'PO' WHEN l_tax < 0.055 THEN '' END AS pipo_indicator,
               p_name AS material_phase_out_phase_in, p_name AS iopt_initiative_name,
               CAST(p_size AS STRING) AS prod_rounding_value,
               CAST(l_extendedprice AS STRING) AS setup_cost_usd, p_type AS abc_mat_fam_name,
               CASE WHEN l_discount < 0.015 THEN '' WHEN l_discount < 0.035 THEN '0.0'
                    ELSE CAST(l_quantity AS STRING) END AS qty_forecast_n12
        FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey""",
    "scale_summary": f"""
        SELECT {_id('o_custkey % 100', 10)} AS vendor_id, {_id('o_orderkey', 7)} AS ticket_id,
               'S-' || CAST(o_orderkey AS STRING) AS ticket_custom_id,
               {_id('o_orderkey', 7)} AS supplier_input_ticket_id,
               CAST(CAST(o_orderdate AS DATE) AS STRING) AS modified_date,
               CASE WHEN o_custkey % 50 = 9 THEN NULL
                    ELSE 'owner' || CAST(o_custkey % 50 AS STRING) || '@example.com'
               END AS ticket_owner,
               CASE WHEN o_orderkey % 2 = 0 THEN '1' ELSE '2' END AS scale_scenario_type,
               CAST(CAST(o_orderdate AS DATE) AS STRING) AS supplier_deadline,
               CASE o_orderstatus WHEN 'F' THEN 'Published'
                    WHEN 'O' THEN 'Awaiting for Supplier input' ELSE 'Draft' END AS ticket_status,
               'buyer@example.com' AS buyer_email, 'supplier@example.com' AS supplier_email,
               'no' AS flag_supplier_inv_storage, o_orderpriority AS ticket_title
        FROM {{orders}}""",
    "scale_raw": f"""
        SELECT CAST(l_suppkey AS STRING) AS vendor_id, 'q' || CAST(l_linenumber AS STRING)
                   AS plant_code,
               CASE WHEN l_tax < 0.045 THEN CAST(l_partkey AS STRING) END AS material_id,
               CASE WHEN l_tax < 0.015 THEN '' ELSE p_type END AS scale_fam, 'EA' AS scale_uom,
               CAST(l_quantity AS STRING) AS mpq_scale_qty, {CURRENCY} AS doc_curr_code,
               CAST(l_extendedprice AS STRING) AS scale_price, '1' AS price_unit_factor,
               {_day('l_shipdate')} AS valid_start_date, {TICKET} AS ticket_id,
               CAST(p_size AS STRING) AS num_gcas_per_family, CAST(p_size AS STRING) AS gcas_per_run
        FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey""",
    "scale_fact": f"""
        SELECT {VENDOR} AS vendor_id, {PLANT} AS plant_code, {MATERIAL} AS material_id,
               p_type AS scale_fam, 'EA' AS scale_uom, l_quantity AS mpq_scale_qty,
               {CURRENCY} AS doc_curr_code, l_extendedprice AS scale_price,
               1 AS price_unit_factor, {TICKET} AS ticket_id
        FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey""",
    "price_scale": f"""
        SELECT {SYSTEM} AS source_system_code, CAST(l_orderkey AS STRING) AS purchase_doc_num,
               CAST(l_linenumber AS STRING) AS purchase_doc_line_num,
               CAST(l_partkey AS STRING) AS cond_rec_num, {_day('l_shipdate')} AS valid_start_date,
               {_day('l_shipdate')} AS valid_end_date, l_quantity AS scale_quantity,
               l_extendedprice AS rate,
               CASE WHEN l_discount < 0.015 THEN 'X' ELSE '' END AS deletion_ind
        FROM {{lineitem}}""",
    "price_validity": f"""
        SELECT {SYSTEM} AS source_system_code, CAST(l_orderkey AS STRING) AS purchase_doc_num,
               CAST(l_linenumber AS STRING) AS purchase_doc_line_num,
               lpad(CAST(l_partkey AS STRING), 10, '0') AS cond_rec_num,
               {_day('l_shipdate')} AS valid_end_date
        FROM {{lineitem}}""",
    "quotation_summary": f"""
        SELECT CAST(o_custkey % 100 AS STRING) AS vendor_id, {_id('o_orderkey', 7)} AS ticket_id,
               CAST(CAST(o_orderdate AS DATE) AS STRING) AS modified_date,
               'owner' || CAST(o_custkey % 50 AS STRING) || '@example.com' AS ticket_owner,
               'buyer@example.com' AS buyer_email,
               CASE WHEN o_orderkey % 2 = 0 THEN '1' ELSE '2' END AS quotation_scenario_type,
               'Q-' || CAST(o_orderkey AS STRING) AS ticket_custom_id,
               {_id('o_orderkey', 7)} AS supplier_input_ticket_id, o_orderpriority AS ticket_title,
               CASE o_orderstatus WHEN 'F' THEN 'Published' ELSE 'Draft' END
                   AS ticket_status,
               'supplier@example.com' AS supplier_email,
               CAST(CAST(o_orderdate AS DATE) AS STRING) AS supplier_deadline_date
        FROM {{orders}}""",
    "quotation_raw": f"""
        SELECT CAST(l_suppkey AS STRING) AS vendor_id, 'p' || CAST(l_linenumber AS STRING)
                   AS plant_code,
               CAST(l_partkey AS STRING) AS material_id,
               CASE WHEN p_size = 7 THEN ' ' ELSE p_brand END AS abc_mat_fam_new_msm,
               'EA' AS base_unit_of_measure, CAST(l_quantity AS STRING) AS qty_forecast_n12,
               CAST(l_quantity * 3 AS STRING) AS qty_forecast_n12_family, 'A' AS abc_segment,
               CAST(l_tax AS STRING) AS freight_factor, 'No' AS flag_supplier_inv_storage,
               CASE WHEN l_linenumber = 2 THEN 'x' ELSE '100' END AS price_unit_factor,
               {CURRENCY} AS doc_curr_code, {_scenarios()}, {TICKET} AS ticket_id
        FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey""",
    "family_quotation": f"""
        SELECT DISTINCT {VENDOR} AS vendor_id, {PLANT} AS plant_code,
               p_brand AS abc_mat_fam_new_msm, 'EA' AS base_unit_of_measure,
               CAST(p_size AS DOUBLE) AS qty_forecast_n12_family, 'A' AS abc_segment,
               0.5 AS freight_factor, 'No' AS flag_supplier_inv_storage, 100 AS price_unit_factor,
               'USD' AS doc_curr_code, {_scenarios(text=False)}, {TICKET} AS ticket_id
        FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey""",
    "movement": f"""
        SELECT {MATERIAL} AS matnr, {PLANT} AS werks,
               CASE WHEN l_discount < 0.035 THEN 'USD' WHEN l_discount < 0.075 THEN 'EUR'
                    ELSE 'JPY' END AS waers,
               CASE l_returnflag WHEN 'A' THEN '551' WHEN 'R' THEN '556' ELSE '101' END AS bwart,
               {_day('l_shipdate')} AS doc_post_date, l_extendedprice AS dmbtr, l_quantity AS menge
        FROM {{lineitem}}""",
    "rate": f"""
        SELECT CASE WHEN o_orderstatus = 'P' THEN 'X' ELSE 'M' END AS exchange_rate_type,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'EUR' WHEN '2-HIGH' THEN 'JPY'
                    WHEN '3-MEDIUM' THEN 'GBP' ELSE 'BRL' END AS currency_from,
               CASE WHEN o_custkey % 7 = 0 THEN 'EUR' ELSE 'USD' END AS currency_to,
               CAST({_day('o_orderdate')} AS INT) AS exchange_rate_valid_from,
               CAST(o_custkey % 50 AS DOUBLE) / 10 AS exchange_rate, o_custkey % 3 AS ratio_from
        FROM {{orders}}""",
    "price_material": f"""
        SELECT {_id('p_partkey', 18)} AS material_id, {_id('p_size % 7 + 1', 4)} AS plant_code,
               p_retailprice AS price_std_per_unit_usd, 'EUR' AS purch_doc_curr_code
        FROM {{part}}""",
    "history": f"""
        SELECT vendor_id, CAST(supplier_deadline_date AS DATE) AS supplier_deadline_date,
               ticket_status, ticket_id, CAST(pipo_horizon_days % 4 AS INT) AS last_reminder
        FROM {{ticket}} WHERE ticket_title <> '5-LOW'""",
    "vendor": f"""
        SELECT {_id('s_suppkey', 10)} AS vendor_id, s_name AS vendor_name,
               s_suppkey AS display_vendor_id
        FROM {{supplier}}""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _names(sql: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", sql)))


class Frames:
    """Frames of one scale folder, by name. A frame is planned once and reused."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            frame = table(self.spark, self.sf_dir, name)
        else:
            sql = DOMAIN[name]
            frame = self.spark.sql(sql, **{n: getattr(self, n) for n in _names(sql)})
        setattr(self, name, frame)
        return frame


_frames: dict[tuple[str, str], Frames] = {}


def frames(spark: SparkSession, sf_dir: str) -> Frames:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _frames:
        _frames[key] = Frames(spark, sf_dir)
    configure(spark)
    return _frames[key]


def _needed(sql: str, found: list[str]) -> list[str]:
    for name in _names(sql):
        if name in DOMAIN and name not in found:
            _needed(DOMAIN[name], found)
            found.append(name)
    return found


def with_frames(sql: str) -> str:
    """SQL text with the frames it names as common table expressions in front."""
    names = _needed(sql, [])
    plain = lambda text: re.sub(r"\{(\w+)\}", r"\1", text)
    frames = ",\n".join(f"{n} AS ({plain(DOMAIN[n])})" for n in names)
    body = plain(sql).strip()
    if not frames:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {frames},\n{body[5:]}"
    return f"WITH {frames}\n{body}"
