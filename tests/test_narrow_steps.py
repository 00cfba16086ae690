"""Wide or repeated rows are not shuffled again for what narrow ones can settle first."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from lotcraft.operators import inventory as V
from lotcraft.operators import mpq as M
from lotcraft.operators import planning as P
from lotcraft.operators import templates as T
from lotcraft.plans import supply_chain as L
from tests.conftest import values
from tests.test_classify_mpq import _prepared
from tests.test_planning import PRICES


@pytest.fixture
def unsized(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_repeated_for_rates_are_not_shuffled(frame):
    totals = frame("material_id string, plant_code string, currency_code string, move_type_code string,"
                   "local_amount_currency double, qty double, date date",
                   ("1", "2", "EUR", "551", 10.0, 1.0, None), ("1", "2", "EUR", "552", 0.0, 1.0, None),
                   ("1", "2", "EUR", "555", None, 1.0, None), ("1", "2", "GBP", "551", 5.0, 1.0, None),
                   ("1", "2", "USD", "551", 3.0, 1.0, None), ("01", "2", "EUR", "551", 10.00001, 1.0, None))
    agr = frame("material_id string, plant_code string, business_unit string,"
                "business_unit_lkp_code string", ("1", "2", "b", "u"), ("01", "2", "b", "u"))
    price = frame("material_id string, plant_code string, purch_doc_curr_code string,"
                  "price_std_per_unit_usd double", ("3", "2", "EUR", 4.0))
    lead = frame("material_id string, plant_code string, itm_rank int, purchase_vendor_id string",
                 ("1", "2", 1, "v"), ("01", "2", 1, "v"))
    rates = frame("currency_from string, currency_to string, exchange_rate double, ratio_from double",
                  ("EUR", "USD", 2.0, 1.0), ("EUR", "USD", 4.0, 2.0), ("EUR", "USD", 3.0, 1.0),
                  ("EUR", "USD", 0.0, 1.0), ("EUR", "USD", 1.0, 0.0), ("USD", "USD", 7.0, 1.0))
    fact = V.movement_fact(totals, agr, price, lead, rates)
    got = values(fact, "currency_code", "move_type_code", F.round("usd_amount", 3).alias("usd"))
    assert got == sorted([
        ("EUR", "551", 0.0), ("EUR", "551", 20.0), ("EUR", "551", 20.0), ("EUR", "551", 30.0),
        ("EUR", "551", 30.0), ("EUR", "551", None), ("EUR", "552", 0.0), ("EUR", "552", None),
        ("EUR", "555", None), ("GBP", "551", None), ("USD", "551", 3.0)], key=repr)
    above, found, _ = plan(fact).partition("Generate explode")
    assert found and "Exchange" not in above


def test_average_after_harmonising_needs_no_exchange(frame, unsized):
    df = frame(PRICES, ("v", "p", "one", 10, "USD", 1.0), ("v", "p", "two", 10, "USD", 3.0))
    grain = ["purchase_vendor_id", "plant_code", "material_id", "price_unit_factor", "doc_curr_code"]
    means = P.average_prices(P.harmonise_price_lines(df), grain, ["price_purch_rate"])
    assert plan(means).count("Exchange hashpartitioning") == 2


def test_flags_are_settled_before_lines_are_expanded(frame):
    above, found, _ = plan(M.optimal_mpq(M.scenario_rows(_prepared(frame)))).partition("Generate explode")
    assert found and "lower(" not in above and "decimal" not in above


def test_families_are_settled_without_the_lines_other_columns(frame, monkeypatch):
    written = []

    def spy(df, name="step"):
        written.append((name, df.columns))
        return df

    monkeypatch.setattr(L, "cut_lineage", spy)
    lines = frame(
        "ticket_id string, ticket_custom_id string, abc_mat_fam_name string, abc_mat_fam_new_msm string,"
        "material_id string, price_purch_rate_usd double, price_unit_factor int, qty_forecast_n12 double,"
        "min_prod_qty double, note string",
        ("1", "T", "f", "A", "5", 10.0, 1, 30.0, 10.0, "x"), ("1", "T", "f", "A", "6", 10.0, 1, 50.0, 10.0, "x"),
        ("1", "T", "7", "B", "7", 10.0, 1, 20.0, 10.0, "y"), (None, None, "f", "A", "8", 1.0, 1, 4.0, 2.0, "z"))
    fact = L.annual_runs_fact(lines)
    assert values(fact, "material_id", "annual_fcst_cons_current", "current_annual_runs", "family_percentage",
                  "abc_segment", "current_annual_runs_weighted", "total_family_spend") == sorted([
        ("5", 80.0, 8.0, 80.0, "A", 3.0, 800.0), ("6", 80.0, 8.0, 80.0, "A", 5.0, 800.0),
        ("7", 20.0, 2.0, 20.0, "C", 2.0, 200.0), ("8", 4.0, 2.0, None, None, None, 4.0)], key=repr)
    assert written and all("note" not in columns for _, columns in written)


def carried(df, column):
    """Exchanges whose rows hold a column."""
    jvm = df.sparkSession.sparkContext._jvm
    text = jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    inputs = re.findall(r"^\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]$", text, re.MULTILINE)
    return sum(any(c.split("#")[0] == column for c in found.split(", ")) for found in inputs)


def _template(frame, known_plants=False):
    names = ("purchase_vendor_id plant_code material_id source_system_code business_unit business_unit_lkp_code "
             "spend_pool_low_name mm_minimum_lot_size min_prod_qty restriction_min_prod_qty "
             "restriction_max_prod_qty material_per_pallet_qty pipo_indicator material_phase_out_phase_in "
             "iopt_initiative_name prod_rounding_value setup_cost_usd abc_mat_fam_name qty_forecast_n12").split()

    def row(vendor, material, plant="P", system="S", **given):
        known = {"purchase_vendor_id": vendor, "material_id": material, "plant_code": plant,
                 "source_system_code": system, "qty_forecast_n12": "5", **given}
        return tuple(known.get(c) for c in names)

    fact = frame(", ".join(f"{c} string" for c in names), row("01", "07"), row("01", "07"), row("1", "07"),
                 row("01", "7"), row("x", "07"), row("y", "07"), row(None, "07"), row("01", "07", None),
                 row("01", "07", "Q"), row("01", "07", system="T"), row("01", "07", system=None), row("01", "08"),
                 row("01", "09"), row("01", None), row("01", "07", qty_forecast_n12="0", setup_cost_usd="1"))
    keys = "vendor_id string, plant_code string, material_id string, "
    return T.supplier_template(
        fact,
        frame("material_number string, material_desc string, base_unit_of_measure string, material_group string",
              ("7", "seven", "EA", "g"), ("007", "sieben", "EA", None), ("8", "eight", "EA", "g")),
        frame("spend_pool_lkp_code string, spend_pool_high_name string", ("g", "PACKAGING")),
        frame("plant_code string, lead_vendor_id string, vendor_plant_change_freq double",
              ("P", "01", 10.0), ("P", "01", 11.0), ("P", "x", 12.0), ("P", None, 13.0)),
        frame("purchase_vendor_id string, plant_code string, material_id string, plant_name string,"
              "purchase_doc_type_desc string", ("01", "P", "07", "one", "a"), ("01", "P", "07", "two", "a"),
              ("01", "P", "07", "two", "a"), ("x", "P", "07", "three", "b"), (None, "P", "07", "none", "c")),
        frame(keys + "ticket_id string, pallet_stacking_factor string", ("01", "P", "07", "1", "4"),
              ("01", "P", "07", "2", "3"), ("1", "P", "07", "1", "6"), ("01", "P", "07", "2", None)),
        frame("plant_code string, region_override string", ("P", "GC")),
        frame("source_system_code string, material_id string, material_shelf_life_months string",
              ("S", "07", "12"), ("S", "07", "18"), ("T", "07", ""), (None, "07", "1"), ("S", "7", "24"),
              ("S", "08", "6")),
        frame("vendor_id string, material_id string, min_prod_quantity double, production_family string",
              ("1", "7", 2.0, "f"), ("001", "7", 3.0, "g"), (None, "7", 4.0, "h")),
        frame("code string, category string", ("u", "core")), known_plants)


def test_planning_rows_cross_the_network_once_for_what_is_known_of_a_pair(frame, unsized):
    # Once for vendor and material, region, unit and the distinct rows behind them.
    assert carried(_template(frame), "restriction_max_prod_qty") <= 4


# Vendor, plant as text, plant, shelf life, least quantity, stacking factor and frequency of the first of
# what repeats: the material's text, the least quantity of vendor 1 and the frequency of its first spelling.
TEMPLATE = [
    (1, "P: one", "P", "", "2.0", 3, 10.0),
    (1, "P: one", "P", "12", "2.0", 3, 10.0),
    (1, "P: one", "P", "18", "2.0", 3, 10.0),
    (1, "P: two", "P", "", "2.0", 3, 10.0),
    (1, "P: two", "P", "12", "2.0", 3, 10.0),
    (1, "P: two", "P", "18", "2.0", 3, 10.0),
    (1, None, "P", "12", "2.0", 6, 180.0),
    (1, None, "P", "18", "2.0", 6, 180.0),
    (1, None, "P", "24", "2.0", None, 10.0),
    (1, None, "P", "6", None, None, 10.0),
    (1, None, "Q", "12", "2.0", None, 180.0),
    (1, None, "Q", "18", "2.0", None, 180.0),
    (1, None, None, "12", "2.0", None, 180.0),
    (1, None, None, "18", "2.0", None, 180.0),
    (None, "P: three", "P", "12", None, None, 12.0),
    (None, "P: three", "P", "18", None, None, 12.0),
    (None, None, "P", "12", None, None, 180.0),
    (None, None, "P", "18", None, None, 180.0),
]


def test_template_keeps_spellings_systems_and_missing_vendors_apart(frame):
    rows = _template(frame).collect()
    first = {(r["vendor_id"], r["plant_code"], r["only_plant_code"], r["material_shelf_life_months"],
              r["min_prod_qty"], r["pallet_stacking_factor"], r["vendor_plant_change_freq"]) for r in rows
             if r["material_desc"] != "sieben" and r["min_prod_qty"] != "3.0" and r["vendor_plant_change_freq"] != 11}
    assert len(rows) == len(set(rows)) == 90 and sorted(first, key=repr) == TEMPLATE
    known = _template(frame, known_plants=True).collect()
    assert len(known) == 74 and {r["only_plant_code"] for r in known} == {"P"}


def test_plan_rows_are_counted_where_they_meet_their_place(frame, unsized):
    plan_rows = frame("agreement_naturalkey string, material_id string, plant_code string",
                      ("k", "m", "p"), ("k", "m", "p"), ("l", "m", "q"), (None, "m", "p"))
    needs = frame("material_id string, plant_code string, rows_n13 long, qty_n13 double, rows_n12m long,"
                  "qty_n12m double", ("m", "p", 1, 1.0, 1, 2.0))
    listed = P._needs_per_agreement(plan_rows, needs)
    assert values(listed, F.col("agreement_naturalkey"), F.col("_n13.qty"), F.col("_n12m.qty")) == [
        ("k", [2.0], [4.0])]
    # By place, and by agreement.
    assert carried(listed, "agreement_naturalkey") == 2


def test_input_rows_are_made_distinct_where_they_meet_their_override(frame, unsized):
    def row(schema, **given):
        names = [c.split() for c in schema.split(", ")]
        return frame(schema, tuple(given.get(n) for n, _ in names))

    def text(names, **given):
        return row(", ".join(f"{n} string" for n in names.split()), **given)

    own = {"material_id": "m", "plant_code": "p", "agreement_naturalkey": "k"}
    given = row("vendor_id string, material_id string, plant_code string, base_uom string, abc_mat_fam_name string, "
                "abc_mat_fam_new_msm string, restriction_min_prod_qty double, restriction_max_prod_qty double, "
                "material_per_pallet_qty double, min_prod_qty double, ticket_id string, setup_cost_usd double, "
                "prod_rounding_value double, material_shelf_life_months double, vendor_plant_change_freq double, "
                "supplier_input_repeats int", vendor_id="v", ticket_id="t", setup_cost_usd=3.0, **own)
    out = P.enrich_agreements(
        text("agreement_naturalkey source_system_code purchase_vendor_id plant_code material_id price_unit_factor "
             "doc_curr_code net_price_rate price_purch_usd spend_pool_lkp_code spend_pool_group "
             "spend_pool_medium_name spend_pool_low_name business_unit_lkp_code sector_business_unit business_unit "
             "source_list_flag", purchase_vendor_id="v", source_list_flag="Y", **own),
        row("agreement_naturalkey string, material_id string, plant_code string, mm_minimum_lot_size double", **own),
        row("material_id string, plant_code string, rows_n13 long, qty_n13 double, rows_n12m long, qty_n12m double",
            rows_n13=1, qty_n13=1.0, rows_n12m=1, qty_n12m=1.0, **own),
        text("plant_code material_id batch_volume_uom usage_uom weight cov_usage inventory sync"),
        given.union(given),
        row("vendor_id string, material_id string, ticket_id string, qty_forecast_override double"),
        text("vendor_id ticket_id forecast_override_flag future_supplier_storage_flag"), None,
        text("site_code country_code"), text("country_code nominal_wacc scrap_extra_charges"))
    assert values(out, "material_id", "ticket_id", "setup_cost_usd") == [("m", "t", 3.0)]
    # For the override, the ticket, the agreement, the plant and the rates.
    assert carried(out, "setup_cost_usd") == 5


LINE_TABLES = {
    "agreement": "agreement_naturalkey string, source_system_code string, purchase_vendor_id string, plant_code string, "
                 "material_id string, price_unit_factor int, doc_curr_code string, net_price_rate double, "
                 "price_purch_usd double, spend_pool_lkp_code string, spend_pool_group string, "
                 "spend_pool_medium_name string, spend_pool_low_name string, business_unit_lkp_code string, "
                 "sector_business_unit string, business_unit string, source_list_flag string",
    "plan": "agreement_naturalkey string, material_id string, plant_code string, mm_minimum_lot_size double",
    "consumption": "material_id string, plant_code string, material_type string, "
                   "requirement_date_for_the_component string, sum_total_requirement_qty double",
    "sync": "plant_code string, material_id string, batch_volume_uom double, usage_uom double, weight double, "
            "cov_usage double, inventory double, sync double",
    "input": "vendor_id string, material_id string, plant_code string, base_uom string, abc_mat_fam_name string, "
             "abc_mat_fam_new_msm string, restriction_min_prod_qty double, restriction_max_prod_qty double, "
             "material_per_pallet_qty double, min_prod_qty double, ticket_id string, setup_cost_usd double, "
             "prod_rounding_value double, material_shelf_life_months double, vendor_plant_change_freq double, "
             "supplier_input_repeats int",
    "override": "vendor_id string, material_id string, ticket_id string, qty_forecast_override double",
    "trigger": "vendor_id string, ticket_id string, commercial_transparency_flag string, "
               "forecast_override_flag string, future_supplier_storage_flag string, modified_date string, "
               "ticket_owner string, ticket_custom_id string, ticket_title string, pipo_horizon_days int",
    "material": "material_number string, material_desc string",
    "plant": "site_code string, country_code string",
    "finance": "country_code string, nominal_wacc double, scrap_extra_charges double",
    "storage": "vendor_id string, material_id string, storage_unit_quantity double",
    "initiative": "iopt_initiative_po_material_id string, iopt_initiative_pi_material_id string, plant_code string, "
                  "iopt_initiative_name string",
}


def _line_tables(frame):
    vendor, material, other, ticket = "v".rjust(10, "0"), "m".rjust(18, "0"), "n".rjust(18, "0"), "t".rjust(7, "0")
    plant = "000p"
    own = {"vendor_id": vendor, "purchase_vendor_id": vendor, "plant_code": plant, "site_code": plant,
           "material_id": material, "material_number": material, "ticket_id": ticket, "source_list_flag": "Y",
           "country_code": "C", "commercial_transparency_flag": "no", "forecast_override_flag": "yes"}
    given = {
        "agreement": [dict(agreement_naturalkey=k, price_unit_factor=f, doc_curr_code=c, net_price_rate=r, **more)
                      for k, f, c, r, more in (
                          ("k", 1, "USD", 3.0, {}), ("k", 1, "USD", 3.0, {}), ("l", 10, "USD", 5.0, {}),
                          ("o", 1, "USD", 7.0, {"material_id": other}),
                          ("w", 1, "USD", 9.0, {"material_id": None}),
                          ("x", 1, "USD", 1.0, {"plant_code": "000q"}),
                          ("y", 1, "EUR", 1.0, {"plant_code": "000q"}),
                          ("z", 1, "EUR", 1.0, {"source_list_flag": "N"}))],
        "plan": [dict(agreement_naturalkey=k, mm_minimum_lot_size=lot) for k, lot in (
            ("k", 91.0), ("k", 91.0), ("l", 91.0), ("o", 5.0), ("w", 6.0), ("x", 1.0), ("y", 1.0), ("z", 1.0))],
        "consumption": [{"requirement_date_for_the_component": "19980102", "sum_total_requirement_qty": 91.0}],
        "sync": [{"batch_volume_uom": 4.0}],
        "input": [{"ticket_id": "0000000", "setup_cost_usd": 1.0}, {"setup_cost_usd": 2.0}, {"setup_cost_usd": 2.0},
                  {"setup_cost_usd": 8.0, "supplier_input_repeats": 2}],
        "override": [{"qty_forecast_override": 12.0}],
        "trigger": [{"ticket_custom_id": "T"}],
        "material": [{"material_desc": "text"}], "plant": [{}], "finance": [{"nominal_wacc": 0.5}],
        "storage": [{"storage_unit_quantity": 6.0}, {"storage_unit_quantity": 8.0}],
        "initiative": [{"iopt_initiative_po_material_id": other, "iopt_initiative_pi_material_id": material,
                        "iopt_initiative_name": "I"}],
    }

    def table(name):
        columns = [c.split()[0] for c in LINE_TABLES[name].split(", ")]
        return frame(LINE_TABLES[name], *(tuple({**own, **row}.get(c) for c in columns) for row in given[name]))

    return {name: table(name) for name in LINE_TABLES}


def test_price_lines_are_dealt_once_by_material(frame, unsized, monkeypatch):
    import datetime as dt

    written = {}

    def spy(df, name="step"):
        written[name] = (plan(df), carried(df, "net_price_rate"), carried(df, "setup_cost_usd"))
        return df

    monkeypatch.setattr(L, "cut_lineage", spy)
    lines = L.price_lines(_line_tables(frame), dt.date(1998, 1, 1))
    got = values(lines, F.ltrim(F.translate("material_id", "0", " ")).alias("m"), "price_unit_factor", "setup_cost_usd",
                 "qty_forecast_n12", "material_per_pallet_qty", "ticket_custom_id", "iopt_initiative_name",
                 "pipo_indicator", "material_desc", "avg_batch_consumption_qty", "mm_minimum_lot_size_dfc",
                 "price_purch_rate")
    # Two factors of one currency become 1, a repeated plan row counts its consumption twice; a factor
    # with two currencies and a missing key go.
    assert got == sorted([
        ("m", 1, 2.0, 12.0, 8.0, "T", "i", "PO", "text", 4.0, 68.25, 4.0),
        ("n", 1, None, 91.0, None, None, "", "", None, None, 5.0, 7.0)], key=repr)
    # By material; no table is broadcast here, so the plants cost an exchange and one back.
    assert written["lines"][1:] == (3, 3)


def test_scenarios_of_small_families_cross_no_exchange(frame):
    prepared = _prepared(frame)
    best = M.best_quantities(prepared)
    assert values(best) == values(M.optimal_mpq(M.scenario_rows(prepared)))
    assert values(M.best_quantities(prepared, at_once=1)) == values(best)
    small, found, _ = plan(best).partition("Generate explode")
    assert found and "Exchange" not in small
