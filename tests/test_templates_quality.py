from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lotcraft.functions import fiscal_year, unique_rows_only
from lotcraft.operators import incremental as N
from lotcraft.operators import inventory as V
from lotcraft.operators import payload as Y
from lotcraft.operators import quality as Q
from lotcraft.operators import templates as T
from tests.conftest import values


def test_shelf_life_text(frame):
    df = frame("material_id string, source_system_code string, material_type string,"
               "calc_shelf_life int", ("a", "s", "t", 5), ("a", "s", "t", 3), ("b", "s", "t", 0),
               ("b", "s", "t", 9), ("c", "s", "t", None))
    assert values(T.shelf_life(df), "material_id", "material_shelf_life_months") == [
        ("a", "3"), ("b", ""), ("c", "")]


def test_change_frequency_defaults(frame):
    freq = frame("plant_code string, iopt_initiative_pi_material_id string,"
                 "change_frequency_times string, change_frequency_avg_days double",
                 ("p", "a", "1", 10.0), ("p", "b", "3", -1.0), ("p", "c", "2", None),
                 ("q", "d", "2", 100.0), ("q", "e", "2", 50.0))
    lead = frame("plant_code string, material_id string, itm_rank int, purchase_vendor_id string",
                 ("p", "a", 1, "v"), ("p", "b", 1, "v"), ("p", "c", 1, "v"), ("q", "d", 1, "w"),
                 ("q", "e", 2, "w"))
    assert values(T.vendor_plant_change_frequency(freq, lead)) == [
        ("p", "v", 365.0), ("q", "w", 100.0)]


def test_region_ladder_takes_the_first_match(frame):
    plant = frame("plant_code string, plant_name string, country_code string",
                  ("1", "a", "x"), ("2", "b", "y"), ("3", "c", "none"))
    geo = frame("country_code string, area string", ("x", "CHINA AND ASIA PACIFIC"),
                ("y", "GREATER CHINA"))
    assert values(T.plant_region(plant, geo), "plant_code", "region_override") == [
        ("1", "AMA-E"), ("2", "GC"), ("3", "missing")]


@pytest.mark.parametrize("forecast, indicator, kept", [
    ("5", None, True), ("0", None, False), ("-1", "", False), ("", None, False),
    (None, "", False), ("0", "PO", True), (None, "PI", True), ("n/a", None, False)])
def test_rows_without_demand(frame, forecast, indicator, kept):
    df = frame("q string, i string", (forecast, indicator))
    assert (df.filter(~T.no_demand("q", "i")).count() == 1) is kept


def test_ambiguous_keys_go_whole_and_null_keys_stay(frame):
    df = frame("vendor_id int, material_id int, plant_code string, mpq_scale_qty int, x int",
               (1, 1, "p", 5, 1), (1, 1, "p", 5, 2), (1, 1, "p", 6, 3), (None, 1, "p", 5, 4),
               (None, 1, "p", 5, 5))
    assert values(T.drop_ambiguous(df), "x") == [(3,), (4,), (5,)]


def test_copies_with_a_null_key_all_stay(spark):
    key = ["k"]
    df = spark.range(0, 150_000, 1, 4).select(
        F.when(F.col("id") == 7, F.lit(7)).alias("k"), F.lit("same").alias("v"))
    out = unique_rows_only(df, key)
    assert out.columns == ["k", "v"]
    assert values(out.groupBy("k", "v").count(), "k", "v", "count") == [
        (7, "same", 1), (None, "same", 149_999)]
    assert values(unique_rows_only(df.select("k"), key).groupBy("k").count(), "k", "count") == [
        (7, 1), (None, 149_999)]


def test_one_row_per_key_and_latest_attribute(frame):
    df = frame("vendor_id int, material_id int, plant_code string, t string, v int",
               (1, 1, "p", "b", 9), (1, 1, "p", "a", 3), (1, 1, "p", "a", 2), (2, 1, "p", None, 7))
    assert values(T.one_row_per_key(df)) == [(1, 1, "p", "a", 2), (2, 1, "p", None, 7)]
    assert values(T.latest_attribute(df, ["vendor_id"], "t", "v")) == [(1, 9), (2, 7)]


def test_longest_valid_scale(frame):
    line = "source_system_code string, purchase_doc_num string, purchase_doc_line_num string,"
    pv = frame(line + "cond_rec_num string, valid_end_date string", ("S", "1", "1", "007", "2024"),
               ("S", "1", "1", "8", "2023"), ("Z", "1", "1", "7", "2024"))
    ps = frame(line + "cond_rec_num string, valid_start_date string, valid_end_date string,"
               "scale_quantity int, rate double, deletion_ind string",
               ("S", "1", "1", "7", "2020", "2024", 10, 1.5, ""),
               ("S", "1", "1", "7", "2020", "2024", 20, 1.2, "X"),
               ("S", "1", "1", "8", "2020", "2023", 30, 1.1, ""))
    agr = frame(line + "purchase_vendor_id string, plant_code string, plant_name string,"
                "material_id string, order_uom string, doc_curr_code string,"
                "price_unit_factor int, source_list_flag string",
                ("S", "1", "1", "01", "p", "P", "02", "EA", "USD", 1, "Y"),
                ("S", "1", "1", "03", "p", "P", "02", "EA", "USD", 1, "N"))
    out = T.latest_valid_price_scale(agr, ps, pv, ["S"])
    assert values(out, "vendor_id", "material_id", "mpq_scale_qty") == [(1, 2, 10)]


def test_json_is_valid_and_blanks_are_text(frame):
    df = frame("a string, b int, c string", ('say "hi"', None, " "), (None, 3, "é"))
    out = Y.row_json(Y.nulls_to_blank(df), ["a", "b", "c"])
    assert values(out, "jsonObject") == [
        ('{"Values":["","3","é"]}',), ('{"Values":["say \\"hi\\"","",""]}',)]
    assert values(Y.blanks_to_null(df), "c") == sorted([(None,), ("é",)], key=repr)


def test_payload_keeps_every_copy_in_bounded_bodies(frame):
    for times in (1, 10):  # ten times the rows and ten batches of one text
        rows = [("s", '{"v":"é1"}')] * 25 * times
        rows += [("s", f'{{"v":"{i}"}}') for i in range(40 * times)]
        df = frame("source_system_code string, jsonObject string", *rows, ("other", "x"))
        bodies = Y.region_payload(df, ["s"], 10).collect()
        assert sum(b["rows"] for b in bodies) == 65 * times
        joined = ",".join(b["body"] for b in bodies)
        assert joined.count('{"v":"1"}') == 25 * times + 1 and "é" not in joined and "x" not in joined
        assert all(b["body"].count('{"v"') == b["rows"] <= 10 for b in bodies)
        assert all(b["rows"] == 10 for b in bodies if b["bucket"] == -1)
        assert len({(b["bucket"], b["slice"]) for b in bodies}) == len(bodies)


def test_movements_and_usd_amounts(frame):
    mseg = frame("matnr string, werks string, waers string, bwart string, doc_post_date string,"
                 "dmbtr double, menge double", ("1", "2", "EUR", "551", "20200701", 10.0, 1.0),
                 ("1", "2", "EUR", "551", "20200701", 5.0, 1.0),
                 ("1", "2", "EUR", "551", "20200630", 7.0, 1.0),
                 ("1", "2", "EUR", "101", "20200701", 7.0, 1.0),
                 ("1", "2", "USD", "552", "20210630", 3.0, 1.0),
                 ("1", "2", "JPY", "552", "20210630", 3.0, 1.0))
    rates = frame("exchange_rate_type string, currency_from string, currency_to string,"
                  "exchange_rate_valid_from int, exchange_rate double, ratio_from double",
                  ("M", "EUR", "USD", 20220101, 2.0, 1.0), ("M", "EUR", "USD", 20220101, 2.0, 1.0),
                  ("M", "EUR", "USD", 20210801, 9.0, 1.0), ("X", "EUR", "USD", 20230101, 9.0, 1.0),
                  ("M", "JPY", "USD", 20220101, 2.0, 0.0))
    latest = V.latest_exchange_rate(rates)
    assert values(latest, "currency_from", "exchange_rate") == [("EUR", 2.0), ("JPY", 2.0)]
    agr = frame("material_id string, plant_code string, business_unit string,"
                "business_unit_lkp_code string", ("1", "2", None, "u"))
    price = frame("material_id string, plant_code string, purch_doc_curr_code string,"
                  "price_std_per_unit_usd double", ("1", "2", "EUR", 4.0))
    lead = frame("material_id string, plant_code string, itm_rank int, purchase_vendor_id string",
                 ("1", "2", 1, "v"), ("1", "2", 2, "w"))
    fact = V.movement_fact(V.movement_totals(mseg), agr, price, lead, latest)
    assert values(fact, "currency_code", "usd_amount", "fiscal_year_num", "business_unit") == [
        ("EUR", 30.0, 2021, ""), ("JPY", None, 2021, ""), ("USD", 3.0, 2021, "")]


def test_fiscal_year_turns_in_july(frame):
    df = frame("d string", ("2023-06-30",), ("2023-07-01",)).select(fiscal_year(F.to_date("d")))
    assert values(df) == [(2023,), (2024,)]


def test_months_before_clips_to_the_month():
    assert V.months_before(dt.date(2024, 3, 31), 1) == dt.date(2024, 2, 29)
    assert V.months_before(dt.date(2024, 12, 5), 48) == dt.date(2020, 12, 5)


def test_appending_twice_adds_nothing(frame):
    schema = "k int, v string, modified_date date"
    day = dt.date(2024, 1, 20)
    source = frame(schema, (1, "a", day), (1, "a", day), (2, None, day), (3, "c", day),
                   (4, "d", dt.date(2023, 1, 1)))
    target = frame(schema + ", is_processed boolean", (3, "c", day, True))
    new = N.append_new_rows(source, target, dt.date(2024, 1, 1))
    assert values(new, "k", "v", "is_processed") == [(1, "a", False), (2, None, False)]
    again = N.append_new_rows(source, target.unionByName(new), dt.date(2024, 1, 1))
    assert again.count() == 0


def test_owner_routing_and_digest(frame):
    rows = frame("ticket_id string, vendor_id string, material_id string, plant_code string,"
                 "ticket_custom_id string", ("t", "1", "2", "p", "c"), ("x", "1", "2", "p", "c"),
                 ("n", "5", "2", "p", "c"))
    trig = frame("ticket_id string, ticket_owner string, ticket_status string",
                 ("t", "o@example.com", Q.PUBLISHED), ("t", "o@example.com", Q.PUBLISHED),
                 ("x", "o@example.com", "Draft"), ("n", None, Q.PUBLISHED))
    plan = frame("material_id string, purchase_vendor_id string, ticket_id string,"
                 "ticket_owner string, vendor_name string",
                 ("0" * 17 + "2", "0" * 9 + "1", "q", "p@example.com", "V"))
    owned = Q.resolve_owner(rows, trig, plan)
    assert values(owned, "ticket_id", "ticket_owner", "vendor_name") == sorted([
        ("t", "o@example.com", "V"), ("n", None, None)], key=repr)
    routed = Q.route_recipient(owned, ".+@example[.]com", "desk@example.com")
    assert values(routed, "ticket_id", "recipient") == [
        ("n", "desk@example.com"), ("t", "o@example.com")]
    excluded = Q.route_recipient(owned, ".+@example[.]com", "desk@example.com", "z")
    assert values(excluded, "ticket_id") == [("t",)]


def test_whole_owner_must_match(frame):
    df = frame("ticket_owner string", ("a@example.com",), ("a@example.com; b",), ("b",))
    out = Q.route_recipient(df, ".+@example[.]com", "desk")
    assert values(out, "is_valid_owner") == [(False,), (False,), (True,)]


def test_digest_pages_hold_every_row(frame):
    rows = [("r", "o", i) for i in range(250)] + [("r", "o", 7)] * 40
    rows += [("s", None, 1), ("s", None, None)]
    df = frame("recipient string, ticket_owner string, n int", *rows)
    pages = Q.digest_by_recipient(df, ["n"], page_rows=20).collect()
    assert all(len(p["rows_shown"]) <= 20 for p in pages)
    of_r = [p for p in pages if p["recipient"] == "r"]
    assert len({p["page"] for p in of_r}) == len(of_r)
    assert {p["rows_total"] for p in of_r} == {290}
    shown = sorted((x["n"], x["copies"]) for p in of_r for x in p["rows_shown"])
    assert shown == [(i, 41 if i == 7 else 1) for i in range(250)]
    (of_s,) = [p for p in pages if p["recipient"] == "s"]
    assert [x["n"] for x in of_s["rows_shown"]] == [None, 1] and of_s["rows_total"] == 2


TICKET = ("vendor_id string, ticket_id string, ticket_status string, ticket_owner string,"
          "ticket_title string, supplier_email string, supplier_deadline_date string")
HISTORY = ("vendor_id string, supplier_deadline_date date, ticket_status string,"
           "ticket_id string, last_reminder int")
STATUS = "Awaiting for Supplier answer"
MONDAY = dt.date(2024, 1, 8)


def _tickets(frame):
    return frame(TICKET, *[("7", t, STATUS, "o", "x", mail, day) for t, mail, day in (
        ("new", "m", "2024-01-07"), ("today", "m", "2024-01-08"), ("three", "m", "2024-01-01"),
        ("two", "m", "2024-01-01"), ("mute", None, "2024-01-01"))],
        ("7", "done", "Published", "o", "x", "m", "2024-01-01"))


def _history(frame):
    day = dt.date(2024, 1, 1)
    return frame(HISTORY, ("7", day, STATUS, "three", 3), ("7", day, STATUS, "two", 2),
                 ("7", dt.date(2023, 1, 1), STATUS, "new", 2))


def test_reminders_every_third_run_on_business_days(frame):
    vendor = frame("vendor_id string, vendor_name string", ("007", "V"))
    due = Q.overdue_reminders(_tickets(frame), vendor, _history(frame), MONDAY)
    assert values(due, "ticket_id", "days_overdue", "last_reminder", "sent_emails",
                  "vendor_name") == [("new", 1, 0, "o;m", "V"), ("three", 7, 3, "o;m", "V")]
    sunday = Q.overdue_reminders(_tickets(frame), vendor, _history(frame), dt.date(2024, 1, 7))
    assert sunday.count() == 0


def test_reminder_history_advances(frame):
    after = N.advance_reminder_history(_tickets(frame), _history(frame), MONDAY)
    assert values(after, "ticket_id", "last_reminder") == [
        ("mute", 1), ("new", 1), ("three", 4), ("two", 3)]
    weekend = N.advance_reminder_history(_tickets(frame), _history(frame), dt.date(2024, 1, 6))
    assert values(weekend) == values(_history(frame))
    only = N.advance_reminder_history(_tickets(frame), _history(frame), MONDAY, seed=False)
    assert values(only, "ticket_id", "last_reminder") == [("new", 3), ("three", 4), ("two", 3)]


def test_recently_published_lets_the_future_pass(frame):
    df = frame("modified_date string, ticket_status string", ("2024-01-02", Q.PUBLISHED),
               ("2024-01-01", Q.PUBLISHED), ("2025-01-01", Q.PUBLISHED), ("2024-01-08", "Draft"))
    assert values(Q.recently_published(df, MONDAY), "modified_date") == [
        ("2024-01-02",), ("2025-01-01",)]


def test_missing_facts(frame):
    inp = frame("ticket_id string, vendor_id string, material_id string, plant_code string",
                ("i", "01", "1", "p"), ("i", "01", "2", "p"), ("j", "01", "3", "p"))
    summary = frame("supplier_input_ticket_id string, ticket_id string, ticket_owner string,"
                    "ticket_custom_id string", ("i", "s", "o", "c"), (None, "z", "o", "c"))
    fact = frame("ticket_id string, vendor_id string, material_id string, plant_code string",
                 ("s", "1", "1", "p"), ("s", "01", "2", "p"))
    assert values(Q.missing_quotation(inp, summary, fact), "material_id") == [("1",)]
    assert Q.missing_price(inp, summary, fact).count() == 0
