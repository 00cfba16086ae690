from __future__ import annotations

import datetime as dt

import pytest

from lotcraft.operators import planning as P
from tests.conftest import values

CONSUMPTION = ("purchase_vendor_id string, plant_code string, material_id string,"
               "material_type string, requirement_date_for_the_component string,"
               "sum_total_requirement_qty double")


def test_horizons_count_whole_months_and_need_planned_rows(frame):
    df = frame(CONSUMPTION,
               ("v", "p", "a", "ROH", "20240101", 1.0), ("v", "p", "a", "ROH", "20250131", 2.0),
               ("v", "p", "a", "ROH", "20250201", 4.0), ("v", "p", "a", "ROH", "20231231", 8.0),
               ("v", "p", "a", "FERT", "20240430", 16.0), ("v", "p", "a", "FERT", "20240501", 32.0),
               ("v", "p", "b", "FERT", "20240201", 64.0))
    out = P.consumption_month_horizons(df, dt.date(2024, 1, 31))
    assert values(out) == [("v", "p", "a", 3.0, 49.0, 98.0, 17.0, 68.0)]


def test_within_days_counts_what_is_overdue(frame):
    df = frame(CONSUMPTION, ("v", "p", "a", "ROH", "20200101", 1.0),
               ("v", "p", "a", "ROH", "20240401", 2.0), ("v", "p", "a", "ROH", "20240402", 4.0))
    out = P.consumption_within_days(df, ["material_id"], 91, dt.date(2024, 1, 1))
    assert values(out) == [("a", 3.0)]


def test_cover_is_null_without_consumption(frame):
    df = frame("qty_consumption_n13 double, mm_minimum_lot_size double, min_prod_qty double",
               (91.0, 10.0, 5.555), (0.0, 10.0, 5.0), (None, 10.0, 5.0), (728.0, 5915.0, 1.0))
    out = P.days_forward_cover(df)
    assert values(out, "mm_minimum_lot_size_dfc", "min_prod_qty_dfc") == sorted(
        [(10.0, 5.56), (None, None), (None, None), (739.38, 0.13)], key=repr)


def test_latest_ticket_keeps_ties_and_treats_nulls_by_form(frame):
    df = frame("k string, ticket_id string, n int", ("a", "2", 1), ("a", "2", 2), ("a", "1", 3),
               ("a", None, 4), ("b", None, 5), (None, "9", 6), (None, "8", 7))
    assert values(P.latest_by_max_join(df, ["k"]), "n") == [(1,), (2,)]
    assert values(P.latest_by_rank(df, ["k"]), "n") == [(1,), (2,), (5,), (6,)]


def test_forecast_choice_with_and_without_value(frame):
    df = frame("forecast_override_flag string, qty_forecast_override double,"
               "total_requirement_qty double", ("yes", 1.0, 9.0), ("Yes", None, 9.0),
               ("no", 1.0, 9.0), (None, 1.0, 9.0))
    assert [r[-1] for r in P.resolve_forecast(df).collect()] == [1.0, 9.0, 9.0, 9.0]
    loose = P.resolve_forecast(df, need_value=False)
    assert [r[-1] for r in loose.collect()] == [1.0, None, 9.0, 9.0]


def test_initiatives_are_cleaned_sorted_and_repeated(frame):
    df = frame("iopt_initiative_po_material_id string, plant_code string,"
               "iopt_initiative_pi_material_id string, iopt_initiative_name string",
               ("0012", "p", "0034", "Zed-1"), ("0012", "p", "0034", "a/B"),
               ("0012", "p", "0034", "ZED 1"), ("0012", "p", None, None))
    out = P.initiatives_per_pair(df)
    assert values(out, "iopt_initiative_name", "material_phase_out_phase_in") == [
        ("", "12"), ("a b, zed 1, zed 1", "12 - 34")]
    once = P.initiatives_per_pair(df, distinct=True)
    assert values(once, "iopt_initiative_name") == [("",), ("a b, zed 1",)]


@pytest.mark.parametrize("side, expected", [
    ("both", [("in", "PI"), ("none", None), ("out", "PO")]),
    ("po", [("in", None), ("none", None), ("out", "PO")]),
    ("pi", [("in", "PO"), ("none", None), ("out", None)]),
])
def test_phase_indicator_by_side(frame, side, expected):
    lines = frame("material_id string, plant_code string", ("out", "p"), ("in", "p"), ("none", "p"))
    pairs = frame("iopt_initiative_po_material_id string, plant_code string,"
                  "iopt_initiative_pi_material_id string, iopt_initiative_name string,"
                  "material_phase_out_phase_in string", ("out", "p", "in", "n", "out - in"))
    out = P.phase_in_out(lines, pairs, side)
    assert values(out, "material_id", "pipo_indicator") == sorted(expected, key=repr)


PRICES = ("purchase_vendor_id string, plant_code string, material_id string,"
          "price_unit_factor int, doc_curr_code string, price_purch_rate double")


def test_price_cases(frame):
    df = frame(PRICES,
               ("v", "p", "one", 10, "USD", 1.0), ("v", "p", "one", 10, "USD", 3.0),
               ("v", "p", "two", 10, "USD", 1.0), ("v", "p", "two", 100, "USD", 3.0),
               ("v", "p", "three", 10, "USD", 1.0), ("v", "p", "three", 10, "EUR", 3.0),
               ("v", "p", "mix", 10, "USD", 1.0), ("v", "p", "mix", 100, "USD", 2.0),
               ("v", "p", "mix", 1000, "EUR", 3.0), (None, "p", "one", 10, "USD", 3.0))
    out = P.harmonise_price_lines(df)
    assert values(out, "material_id", "price_unit_factor", "price_purch_rate") == sorted([
        ("one", 10, 1.0), ("one", 10, 3.0), ("two", 1, 1.0), ("two", 1, 3.0),
        ("mix", 10, 1.0), ("mix", 100, 2.0), ("mix", 1000, 3.0),
        ("mix", 1, 1.0), ("mix", 1, 2.0), ("mix", 1, 3.0)], key=repr)
    rescaled = P.harmonise_price_lines(df, rescale=True).filter("material_id = 'two'")
    assert values(rescaled, "price_purch_rate") == [(0.03,), (0.1,)]


def test_overrides_keep_wide_tickets_apart(frame):
    """Two tickets of 8 digits that share 7, and one short: each meets its own override."""
    tickets = ["12345671", "12345672", "42"]
    padded = P.padded_overrides(frame(
        "vendor_id string, plant_code string, material_id string, ticket_id string",
        *((("9" * 11), "12345", "m", t) for t in tickets)))
    assert values(padded) == sorted(
        (("9" * 11), "12345", "m".rjust(18, "0"), t.rjust(7, "0")) for t in tickets)

    def rows(columns, texts, *given):
        names = [c for c in columns.split()]
        schema = ", ".join(f"{c} {'string' if c in texts.split() else 'double'}" for c in names)
        return frame(schema, *(tuple(g.get(c) for c in names) for g in given))

    ids = [t.rjust(7, "0") for t in tickets]
    keys = [{"material_id": f"m{i}".rjust(18, "0"), "plant_code": "p", "agreement_naturalkey": f"k{i}"} for i in range(3)]
    texts = ("agreement_naturalkey source_system_code purchase_vendor_id vendor_id plant_code material_id "
             "material_type source_list_flag ticket_id forecast_override_flag future_supplier_storage_flag "
             "material_number material_desc site_code country_code")
    agreements = rows(
        "agreement_naturalkey source_system_code purchase_vendor_id plant_code material_id price_unit_factor "
        "doc_curr_code net_price_rate price_purch_usd spend_pool_lkp_code spend_pool_group spend_pool_medium_name "
        "spend_pool_low_name business_unit_lkp_code sector_business_unit business_unit source_list_flag", texts,
        *({**k, "purchase_vendor_id": "0000000001", "source_list_flag": "Y"} for k in keys))
    plan = rows("agreement_naturalkey material_id plant_code mm_minimum_lot_size", texts, *keys)
    needs = rows("plant_code material_id material_type rows_n13 qty_n13 rows_n12m qty_n12m", texts,
                 *({**k, "material_type": "ROH", "rows_n13": 1.0, "qty_n13": 1.0, "rows_n12m": 1.0,
                    "qty_n12m": 1.0} for k in keys))
    sync = rows("plant_code material_id batch_volume_uom usage_uom weight cov_usage inventory sync", texts, *keys)
    given = rows(
        "vendor_id material_id plant_code base_uom abc_mat_fam_name abc_mat_fam_new_msm restriction_min_prod_qty "
        "restriction_max_prod_qty material_per_pallet_qty min_prod_qty ticket_id setup_cost_usd prod_rounding_value "
        "material_shelf_life_months vendor_plant_change_freq supplier_input_repeats", texts,
        *({**k, "vendor_id": "0000000001", "ticket_id": t} for k, t in zip(keys, ids, strict=True)))
    overrides = rows("vendor_id material_id ticket_id qty_forecast_override", texts,
                     *({"vendor_id": "1", "material_id": f"m{i}", "ticket_id": t, "qty_forecast_override": 10.0 + i}
                       for i, t in enumerate(tickets)))
    trigger = rows("vendor_id ticket_id forecast_override_flag future_supplier_storage_flag", texts,
                   *({"vendor_id": "0000000001", "ticket_id": t, "forecast_override_flag": "yes"} for t in ids))
    out = P.enrich_agreements(
        agreements, plan, needs, sync, given, overrides, trigger,
        rows("material_number material_desc", texts), rows("site_code country_code", texts),
        rows("country_code nominal_wacc scrap_extra_charges", texts))
    assert values(out, "ticket_id", "qty_forecast_n12") == sorted(zip(ids, (10.0, 11.0, 12.0), strict=True))


def test_both_horizons_come_from_one_read(spark, frame):
    cons = frame("material_id string, requirement_date_for_the_component string,"
                 "sum_total_requirement_qty double",
                 ("a", "20240101", 1.0), ("a", "20240401", 2.0), ("a", "20240402", 4.0),
                 ("a", "20241231", 8.0), ("a", "20250101", 16.0), ("b", "20240101", None),
                 ("c", "20240601", 3.0), ("d", None, 5.0))
    out = P.consumption_by_horizon(cons, ["material_id"], dt.date(2024, 1, 1))
    assert values(out, "material_id", "rows_n13", "qty_n13", "rows_n12m", "qty_n12m") == [
        ("a", 2, 3.0, 4, 15.0), ("b", 1, None, 1, None), ("c", 0, None, 1, 3.0)]


def test_needs_follow_repeated_plan_rows_and_every_type(frame):
    plan = frame("agreement_naturalkey string, material_id string, plant_code string",
                 ("k", "m", "p"), ("k", "m", "p"), ("k", "n", "p"), ("l", "n", "p"),
                 ("none", "x", "p"), (None, "m", "p"))
    needs = frame("material_id string, plant_code string, material_type string, rows_n13 long,"
                  "qty_n13 double, rows_n12m long, qty_n12m double",
                  ("m", "p", "ROH", 1, 1.0, 2, 3.0), ("m", "p", "HALB", 0, None, 1, 5.0),
                  ("n", "p", "ROH", 1, None, 1, None))
    found = {r["agreement_naturalkey"]: r
             for r in P._needs_per_agreement(plan, needs).collect()}

    def listed(key, name):
        return sorted((e["qty"] for e in found[key][name]), key=str)

    assert sorted(found) == ["k", "l"]
    assert listed("k", "_n13") == [2.0, None] and listed("k", "_n12m") == [10.0, 6.0, None]
    assert listed("l", "_n13") == [None] and listed("l", "_n12m") == [None]
