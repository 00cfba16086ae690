"""Inventory, incremental load, alerts and reminders over the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.domain import AS_OF
from catalog.registry import R, query, rounded
from lotcraft.functions import fiscal_year
from lotcraft.operators import incremental as N
from lotcraft.operators import inventory as V
from lotcraft.operators import quality as Q
from lotcraft.plans import alerts as A
from lotcraft.sources import write_snapshot
from lotcraft.sources.staging import new_folder

SINCE = dt.date(1997, 7, 1)
ADDRESS = ".+@example[.]com"
FALLBACK = "desk@example.com"

MOVED = """
    moved AS (
        SELECT matnr AS material_id, werks AS plant_code, waers AS currency_code,
               bwart AS move_type_code, sum(dmbtr) AS local_amount_currency, sum(menge) AS qty,
               CAST(strptime(doc_post_date, '%Y%m%d') AS DATE) AS date
        FROM {movement} WHERE bwart IN ('551', '552', '555', '556') AND doc_post_date >= '19970701'
        GROUP BY matnr, werks, waers, bwart, doc_post_date)"""
RATES = """
    valid AS (SELECT * FROM {rate} WHERE exchange_rate_valid_from >= 19960101
                AND exchange_rate_type = 'M' AND currency_to = 'USD'),
    rates AS (
        SELECT DISTINCT v.* FROM valid v JOIN (
            SELECT exchange_rate_type, currency_from, currency_to,
                   max(exchange_rate_valid_from) AS top FROM valid GROUP BY ALL) m
          ON v.currency_from = m.currency_from AND v.exchange_rate_valid_from = m.top)"""


@query("movement_totals", f"""
    WITH {MOVED}
    SELECT material_id, plant_code, currency_code, move_type_code,
           {R('local_amount_currency', 2)} AS local_amount_currency, qty,
           CAST(date AS STRING) AS date
    FROM moved""")
def _(f):
    totals = V.movement_totals(f.movement, since=SINCE)
    return totals.withColumns({"local_amount_currency": rounded("local_amount_currency", 2),
                               "date": F.col("date").cast("string")})


@query("movement_totals_48_months", f"""
    SELECT matnr AS material_id, werks AS plant_code, waers AS currency_code,
           bwart AS move_type_code, {R('sum(dmbtr)', 2)} AS local_amount_currency,
           sum(menge) AS qty, substr(doc_post_date, 1, 4) || '-' || substr(doc_post_date, 5, 2)
               || '-' || substr(doc_post_date, 7, 2) AS date
    FROM {{movement}}
    WHERE bwart IN ('551', '552', '555', '556') AND doc_post_date >= '19940101'
    GROUP BY matnr, werks, waers, bwart, doc_post_date""")
def _(f):
    totals = V.movement_totals(f.movement, since=V.months_before(AS_OF, 48))
    return totals.withColumns({"local_amount_currency": rounded("local_amount_currency", 2),
                               "date": F.col("date").cast("string")})


@query("fiscal_year", """
    SELECT CAST(year(CAST(l_shipdate AS DATE) + INTERVAL 6 MONTH) AS INT) AS fiscal_year_num,
           count(*) AS n_rows FROM lineitem GROUP BY fiscal_year_num""")
def _(f):
    return f.lineitem.groupBy(
        fiscal_year(F.col("l_shipdate").cast("date")).alias("fiscal_year_num")
    ).agg(F.count(F.lit(1)).alias("n_rows"))


@query("latest_exchange_rate", f"WITH {RATES} SELECT * FROM rates")
def _(f):
    return V.latest_exchange_rate(f.rate, since=19960101)


# A currency's factor to USD is settled first, so that every movement is one product.
@query("movement_fact", f"""
    WITH {MOVED}, {RATES},
    factors AS (
        SELECT currency_from AS currency_code, exchange_rate / nullif(ratio_from, 0) AS to_usd
        FROM rates WHERE currency_from <> 'USD'
        UNION ALL SELECT 'USD', 1.0),
    main_vendor AS (SELECT material_id, plant_code, purchase_vendor_id FROM {{lead_vendor}} WHERE itm_rank = 1)
    SELECT DISTINCT right(repeat('0', 18) || material_id, 18) AS material_id,
           right('0000' || plant_code, 4) AS plant_code,
           coalesce(business_unit, '') AS business_unit,
           {R('local_amount_currency', 2)} AS local_amount_currency, moved.currency_code,
           move_type_code, {R('local_amount_currency * to_usd', 2)} AS usd_amount,
           purchase_vendor_id, CAST(moved.date AS STRING) AS date, moved.qty,
           price_std_per_unit_usd, business_unit_lkp_code,
           CAST(year(moved.date + INTERVAL 6 MONTH) AS INT) AS fiscal_year_num
    FROM moved JOIN main_vendor USING (material_id, plant_code)
    LEFT JOIN (SELECT material_id, plant_code, business_unit, business_unit_lkp_code
               FROM {{agreement}}) USING (material_id, plant_code)
    LEFT JOIN (SELECT material_id, plant_code, purch_doc_curr_code AS currency_code,
                      price_std_per_unit_usd FROM {{price_material}}) AS priced
      USING (material_id, plant_code, currency_code)
    LEFT JOIN factors ON factors.currency_code = moved.currency_code""")
def _(f):
    fact = V.movement_fact(
        V.movement_totals(f.movement, since=SINCE), f.agreement, f.price_material, f.lead_vendor,
        V.latest_exchange_rate(f.rate, since=19960101), places=2)
    return fact.withColumn("date", F.col("date").cast("string"))


# The target holds part of the same plan, found by another column than the one compared.
@query("append_new_rows", """
    SELECT DISTINCT purchase_vendor_id, material_id, plant_code, mm_minimum_lot_size,
           CAST(modified_date AS STRING) AS modified_date, FALSE AS is_processed
    FROM (SELECT purchase_vendor_id, material_id, plant_code, mm_minimum_lot_size, modified_date
          FROM {plan} WHERE modified_date >= DATE '2001-10-01'
          EXCEPT
          SELECT purchase_vendor_id, material_id, plant_code, mm_minimum_lot_size, modified_date
          FROM {plan} WHERE plant_region_override = 'GC')""")
def _(f):
    columns = ["purchase_vendor_id", "material_id", "plant_code", "mm_minimum_lot_size",
               "modified_date"]
    target = f.plan.filter("plant_region_override = 'GC'").select(
        *columns, F.lit(True).alias("is_processed"))
    new = N.append_new_rows(f.plan.select(*columns), target, dt.date(2001, 10, 1))
    return new.withColumn("modified_date", F.col("modified_date").cast("string"))


LOADED = ["purchase_vendor_id", "material_id", "plant_code", "mm_minimum_lot_size", "modified_date"]
FIRST_LOAD, SECOND_LOAD = dt.date(1998, 8, 1), dt.date(1998, 11, 1)
EVERYTHING = 40_000  # days; the second load looks back over what the first one took


# A first load of one region, a second of all; each runs twice, as after a failure.
@query("append_increment", f"""
    WITH first AS (
        SELECT DISTINCT {', '.join(LOADED)} FROM {{plan}}
        WHERE plant_region_override = 'GC' AND modified_date >= DATE '{FIRST_LOAD}' - INTERVAL 200 DAY),
    second AS (SELECT DISTINCT {', '.join(LOADED)} FROM {{plan}} EXCEPT SELECT * FROM first)
    SELECT * REPLACE (CAST(modified_date AS STRING) AS modified_date), FALSE AS is_processed, '{FIRST_LOAD}' AS load_date
    FROM first
    UNION ALL
    SELECT * REPLACE (CAST(modified_date AS STRING) AS modified_date), FALSE AS is_processed, '{SECOND_LOAD}' AS load_date
    FROM second""")
def _(f):
    from lotcraft.plans.increment import append_increment, loaded
    from lotcraft.sources.staging import new_folder

    path, rows = new_folder(f.spark, "increments"), f.plan.select(*LOADED)
    region = f.plan.filter("plant_region_override = 'GC'").select(*LOADED)
    for source, day, days in ((region, FIRST_LOAD, 200), (rows, SECOND_LOAD, EVERYTHING)):
        for _ in range(2):
            append_increment(source, path, day, days)
    append_increment(rows, path, SECOND_LOAD + dt.timedelta(days=1), EVERYTHING)  # nothing is left to add
    return loaded(f.spark, path, rows.schema).withColumns(
        {c: F.col(c).cast("string") for c in ("modified_date", "load_date")})


@query("append_new_events", """
    SELECT DISTINCT event_type, user_id, FALSE AS is_processed
    FROM (SELECT event_type, user_id, CAST(ts AS DATE) AS day FROM events
          WHERE CAST(ts AS DATE) >= DATE '2024-01-15'
          EXCEPT SELECT event_type, user_id, CAST(ts AS DATE) FROM events WHERE value >= 20)""")
def _(f):
    daily = f.events.select("event_type", "user_id", F.col("ts").cast("date").alias("day"), "value")
    target = daily.filter("value >= 20").drop("value").withColumn("is_processed", F.lit(True))
    new = N.append_new_rows(daily.drop("value"), target, dt.date(2024, 1, 15), "day")
    return new.drop("day").distinct()


@query("duplicate_keys", """
    SELECT material_id, vendor_id, count(*) AS supplier_input_repeats FROM {input}
    GROUP BY material_id, vendor_id HAVING count(*) > 1""")
def _(f):
    return Q.duplicate_keys(f.input, ["material_id", "vendor_id"], "supplier_input_repeats")


@query("duplicate_documents", """
    SELECT md5(text) AS text_hash, count(*) AS repeats FROM documents
    GROUP BY text HAVING count(*) > 1""")
def _(f):
    return Q.duplicate_keys(f.documents, ["text"]).select(F.md5("text").alias("text_hash"),
                                                          "repeats")


# Small quantities are quoted for another plant, so that their own plant lacks them.
MOVED_FACT = """(SELECT * REPLACE (CASE WHEN mpq_scale_qty > 25 THEN plant_code ELSE 'none' END
                                   AS plant_code) FROM {scale_fact})"""


def _moved_fact(f):
    plant = F.when(F.col("mpq_scale_qty") > 25, F.col("plant_code")).otherwise("none")
    return f.scale_fact.withColumn("plant_code", plant)


MISSING_QUOTATION = f"""
    missing AS (
        SELECT i.ticket_id, i.vendor_id, i.material_id, i.plant_code,
               s.ticket_id AS quotation_summary_ticket_id, s.ticket_custom_id
        FROM {{input}} i JOIN (SELECT * FROM {{quotation_summary}}
                             WHERE ticket_status = 'Published') s
          ON i.ticket_id = s.supplier_input_ticket_id
        ANTI JOIN {MOVED_FACT} q
          ON q.ticket_id = s.ticket_id AND q.vendor_id = i.vendor_id
          AND q.material_id = i.material_id AND q.plant_code = i.plant_code)"""


def _missing_quotation(f):
    published = f.quotation_summary.filter("ticket_status = 'Published'")
    return Q.missing_quotation(f.input, published, _moved_fact(f))


@query("missing_quotation", f"WITH {MISSING_QUOTATION} SELECT * FROM missing")
def _(f):
    return _missing_quotation(f)


@query("missing_price", f"""
    SELECT i.ticket_id, i.vendor_id, i.material_id, i.plant_code,
           s.ticket_id AS price_summary_ticket_id,
           s.ticket_owner AS ticket_owner_from_price_scale_summary, s.ticket_custom_id
    FROM {{input}} i JOIN {{scale_summary}} s ON i.ticket_id = s.supplier_input_ticket_id
    ANTI JOIN (SELECT ticket_id, CAST(CAST(vendor_id AS BIGINT) AS STRING) AS vendor_id,
                      CAST(CAST(material_id AS BIGINT) AS STRING) AS material_id, plant_code
               FROM {MOVED_FACT} m) q
      ON q.ticket_id = s.ticket_id AND CAST(q.vendor_id AS BIGINT) = CAST(i.vendor_id AS BIGINT)
      AND CAST(q.material_id AS BIGINT) = CAST(i.material_id AS BIGINT)
      AND q.plant_code = i.plant_code""")
def _(f):
    short = _moved_fact(f).withColumns({
        c: F.col(c).cast("bigint").cast("string") for c in ("vendor_id", "material_id")})
    return Q.missing_price(f.input, f.scale_summary, short)


@query("recently_published", """
    SELECT ticket_id, modified_date, ticket_status FROM {ticket}
    WHERE date_diff('day', CAST(modified_date AS DATE), DATE '1998-01-01') < 7
      AND ticket_status = 'Published'""")
def _(f):
    return Q.recently_published(f.ticket, AS_OF).select("ticket_id", "modified_date",
                                                        "ticket_status")


OWNED = f"""
    {MISSING_QUOTATION},
    tickets AS (SELECT DISTINCT ticket_id, ticket_owner, ticket_status FROM {{ticket}}
                WHERE ticket_status = 'Published'),
    planned AS (SELECT DISTINCT material_id, purchase_vendor_id, ticket_id, ticket_owner,
                       vendor_name FROM {{plan}}),
    owned AS (
        SELECT m.material_id, m.plant_code, m.vendor_id, p.vendor_name, m.ticket_id,
               coalesce(t.ticket_owner, p.ticket_owner) AS ticket_owner, m.ticket_custom_id
        FROM missing m JOIN tickets t ON t.ticket_id = m.ticket_id
        LEFT JOIN planned p ON p.purchase_vendor_id = m.vendor_id
          AND p.material_id = m.material_id)"""


def _owned(f):
    return Q.resolve_owner(_missing_quotation(f), f.ticket, f.plan)


@query("resolve_owner", f"WITH {OWNED} SELECT * FROM owned")
def _(f):
    return _owned(f)


# The input of published tickets is delivered twice.
DELIVERED = """(
        SELECT material_id, plant_code, vendor_id, ticket_id FROM {input}
        UNION ALL
        SELECT material_id, plant_code, vendor_id, ticket_id FROM {input} i
        SEMI JOIN (SELECT * FROM {ticket} WHERE ticket_status = 'Published') t
          ON t.ticket_id = i.ticket_id)"""
REPEATED = f"""
    repeated AS (
        SELECT material_id, vendor_id, ticket_id, plant_code, count(*) AS supplier_input_repeats
        FROM {DELIVERED} d GROUP BY material_id, vendor_id, ticket_id, plant_code
        HAVING count(*) > 1)"""


def _delivered(f):
    once = f.input.select("material_id", "plant_code", "vendor_id", "ticket_id")
    published = f.ticket.filter("ticket_status = 'Published'").select("ticket_id")
    return once.unionByName(once.join(published, "ticket_id", "left_semi"))


@query("resolve_owner_of_duplicates", f"""
    WITH {REPEATED},
    planned AS (SELECT DISTINCT material_id, purchase_vendor_id, ticket_id, ticket_owner,
                       vendor_name FROM {{plan}})
    SELECT r.material_id, r.plant_code, r.vendor_id, p.vendor_name, r.ticket_id,
           coalesce(t.ticket_owner, p.ticket_owner) AS ticket_owner, supplier_input_repeats,
           t.ticket_custom_id
    FROM repeated r LEFT JOIN {{ticket}} t ON t.ticket_id = r.ticket_id
    LEFT JOIN planned p ON p.purchase_vendor_id = r.vendor_id AND p.material_id = r.material_id""")
def _(f):
    keys = ["material_id", "vendor_id", "ticket_id", "plant_code"]
    repeated = Q.duplicate_keys(_delivered(f), keys, "supplier_input_repeats")
    return Q.resolve_owner(repeated, f.ticket, f.plan, carry=["supplier_input_repeats"],
                           status=None, trigger_columns=["ticket_custom_id"])


@query("resolve_owner_of_prices", f"""
    WITH missing AS (
        SELECT i.ticket_id, i.vendor_id, i.material_id, i.plant_code, s.ticket_owner AS own,
               s.ticket_custom_id
        FROM {{input}} i JOIN {{scale_summary}} s ON i.ticket_id = s.supplier_input_ticket_id
        ANTI JOIN {MOVED_FACT} q
          ON q.ticket_id = s.ticket_id AND q.vendor_id = i.vendor_id
          AND q.material_id = i.material_id AND q.plant_code = i.plant_code),
    tickets AS (SELECT DISTINCT ticket_id, ticket_owner FROM {{ticket}}
                WHERE ticket_status = 'Published'),
    planned AS (SELECT DISTINCT material_id, purchase_vendor_id, ticket_id, ticket_owner,
                       vendor_name FROM {{plan}})
    SELECT m.material_id, m.plant_code, m.vendor_id, p.vendor_name, m.ticket_id,
           coalesce(own, p.ticket_owner) AS ticket_owner, m.ticket_custom_id
    FROM missing m JOIN tickets t ON t.ticket_id = m.ticket_id
    LEFT JOIN planned p ON p.purchase_vendor_id = m.vendor_id AND p.material_id = m.material_id""")
def _(f):
    missing = Q.missing_price(f.input, f.scale_summary, _moved_fact(f))
    return Q.resolve_owner(missing, f.ticket, f.plan,
                           own_owner="ticket_owner_from_price_scale_summary")


ROUTED = f"""
    {OWNED},
    routed AS (
        SELECT *, regexp_full_match(ticket_owner, '.+@example[.]com') AS is_valid_owner,
               CASE WHEN regexp_full_match(ticket_owner, '.+@example[.]com') THEN ticket_owner
                    ELSE '{FALLBACK}' END AS recipient
        FROM owned WHERE ticket_owner <> 'user3@example.com')"""


def _routed(f):
    return Q.route_recipient(_owned(f), ADDRESS, FALLBACK, "user3@example.com")


@query("route_recipient", f"WITH {ROUTED} SELECT * FROM routed")
def _(f):
    return _routed(f)


SHOWN = ["material_id", "plant_code", "vendor_id", "ticket_custom_id"]


RECIPIENT = f"""CASE WHEN regexp_full_match(ticket_owner, '.+@example[.]com') THEN ticket_owner
                ELSE '{FALLBACK}' END AS recipient"""
MAIL_KEYS = ["recipient", "ticket_owner"]


def _paged(source: str, cols: list[str]) -> str:
    """Pages of 100 different rows of `source`, by the same hash as the operator's."""
    by, keys = ", ".join(MAIL_KEYS), ", ".join([*MAIL_KEYS, *cols])
    text = " || '|' || ".join(f"coalesce(CAST({c} AS STRING), '')" for c in cols)
    same = " AND ".join(f"c.{k} IS NOT DISTINCT FROM t.{k}" for k in MAIL_KEYS)
    order = ", ".join(f"{c} NULLS FIRST" for c in cols)
    return f"""
    counted AS (SELECT {keys}, count(*) AS copies FROM {source} GROUP BY {keys}),
    totals AS (SELECT {by}, CAST(sum(copies) AS BIGINT) AS rows_total,
                      (count(*) + 99) // 100 AS spots FROM counted GROUP BY {by}),
    dealt AS (SELECT c.*, rows_total, spots,
                     CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) % spots AS spot
              FROM counted c JOIN totals t ON {same}),
    placed AS (SELECT *, spot + spots * ((row_number() OVER (
                   PARTITION BY {by}, spot ORDER BY {order}) - 1) // 100) AS page FROM dealt)
    SELECT {by}, rows_total, page,
           string_agg({text} || '|' || CAST(copies AS STRING), ';' ORDER BY {order}) AS rows_shown
    FROM placed GROUP BY {by}, rows_total, page"""


def _as_text(digest, cols):
    """Pages with their rows as one text."""
    row = lambda r: F.concat_ws(
        "|", *[F.coalesce(r[c].cast("string"), F.lit("")) for c in [*cols, "copies"]])
    return digest.select(*MAIL_KEYS, "rows_total", "page",
                         F.concat_ws(";", F.transform("rows_shown", row)).alias("rows_shown"))


@query("digest_by_recipient", f"WITH {ROUTED}, {_paged('routed', SHOWN)}")
def _(f):
    return _as_text(Q.digest_by_recipient(_routed(f), SHOWN), SHOWN)


LATE = """lower(s.ticket_status) LIKE 'awaiting for supplier%'
      AND date_diff('day', CAST(s.supplier_deadline_date AS DATE), DATE '1998-01-01') > 0"""
HISTORY = """LEFT JOIN {history} h ON h.vendor_id = s.vendor_id AND h.ticket_id = s.ticket_id
      AND h.ticket_status = s.ticket_status
      AND h.supplier_deadline_date = CAST(s.supplier_deadline_date AS DATE)"""


@query("overdue_reminders", f"""
    SELECT s.vendor_id, v.vendor_name, s.supplier_email, s.supplier_deadline_date,
           CAST(date_diff('day', CAST(s.supplier_deadline_date AS DATE), DATE '1998-01-01')
                AS INT) AS days_overdue,
           s.ticket_status, s.ticket_id, s.ticket_title, s.ticket_owner,
           coalesce(last_reminder, 0) AS last_reminder,
           s.ticket_owner || ';' || s.supplier_email || ';' || s.buyer_email AS sent_emails
    FROM {{ticket}} s {HISTORY}
    LEFT JOIN {{vendor}} v ON CAST(v.vendor_id AS BIGINT) = CAST(s.vendor_id AS BIGINT)
    WHERE {LATE} AND coalesce(last_reminder, 0) % 3 = 0
      AND s.ticket_owner || ';' || s.supplier_email || ';' || s.buyer_email IS NOT NULL""")
def _(f):
    return Q.overdue_reminders(f.ticket, f.vendor, f.history, AS_OF,
                               addresses=("ticket_owner", "supplier_email", "buyer_email"))


@query("advance_reminder_history", f"""
    SELECT s.vendor_id, s.supplier_deadline_date, s.ticket_status, s.ticket_id,
           coalesce(last_reminder, 0) + 1 AS last_reminder
    FROM {{ticket}} s {HISTORY} WHERE {LATE}""")
def _(f):
    first = N.advance_reminder_history(f.ticket, f.history, AS_OF)
    path = write_snapshot(first, new_folder(f.spark, "reminders"), AS_OF.isoformat())
    return f.spark.read.parquet(path)


@query("raise_reminder_counters", """
    SELECT vendor_id, CAST(supplier_deadline_date AS STRING) AS supplier_deadline_date,
           ticket_status, ticket_id, last_reminder + 1 AS last_reminder FROM {history}""")
def _(f):
    raised = N.advance_reminder_history(f.ticket, f.history, AS_OF, seed=False)
    return raised.withColumn("supplier_deadline_date",
                             F.col("supplier_deadline_date").cast("string"))


@query("reminders_on_saturday", """
    SELECT vendor_id, CAST(supplier_deadline_date AS STRING) AS supplier_deadline_date,
           ticket_status, ticket_id, last_reminder FROM {history}""")
def _(f):
    saturday = AS_OF + dt.timedelta(days=(5 - AS_OF.weekday()) % 7)
    kept = N.advance_reminder_history(f.ticket, f.history, saturday)
    return kept.withColumn("supplier_deadline_date",
                           F.col("supplier_deadline_date").cast("string"))


@query("is_business_day", """
    SELECT isodow(CAST(o_orderdate AS DATE)) <= 5 AS business_day, count(*) AS n_rows
    FROM orders GROUP BY business_day""")
def _(f):
    day = Q.is_business_day(F.col("o_orderdate").cast("date"))
    return f.orders.groupBy(day.alias("business_day")).agg(F.count(F.lit(1)).alias("n_rows"))


PLANNED = """
    planned AS (SELECT DISTINCT material_id, purchase_vendor_id, ticket_id, ticket_owner,
                       vendor_name FROM {plan})"""


@query("missing_quotation_digest", f"""
    WITH published AS (
        SELECT * FROM {{quotation_summary}} WHERE ticket_status = 'Published'
           AND date_diff('day', CAST(modified_date AS DATE), DATE '1998-01-01') < 7),
    missing AS (
        SELECT i.ticket_id, i.vendor_id, i.material_id, i.plant_code,
               s.ticket_custom_id
        FROM {{input}} i JOIN published s ON i.ticket_id = s.supplier_input_ticket_id
        ANTI JOIN {MOVED_FACT} q
          ON q.ticket_id = s.ticket_id AND q.vendor_id = i.vendor_id
          AND q.material_id = i.material_id AND q.plant_code = i.plant_code),
    tickets AS (SELECT DISTINCT ticket_id, ticket_owner FROM {{ticket}}
                WHERE ticket_status = 'Published'),
    {PLANNED},
    owned AS (
        SELECT m.*, p.vendor_name, coalesce(t.ticket_owner, p.ticket_owner) AS ticket_owner
        FROM missing m JOIN tickets t ON t.ticket_id = m.ticket_id
        LEFT JOIN planned p ON p.purchase_vendor_id = m.vendor_id
          AND p.material_id = m.material_id),
    routed AS (SELECT *, {RECIPIENT} FROM owned),
    {_paged('routed', A.MISSING_COLUMNS)}""")
def _(f):
    digest = A.missing_quotation_digest(
        f.input, f.quotation_summary, _moved_fact(f), f.ticket, f.plan, AS_OF,
        A.Routing(ADDRESS, FALLBACK))
    return _as_text(digest, A.MISSING_COLUMNS)


@query("missing_price_digest", f"""
    WITH published AS (
        SELECT * FROM {{scale_summary}} WHERE ticket_status = 'Published'
           AND date_diff('day', CAST(modified_date AS DATE), DATE '1998-01-01') < 7),
    missing AS (
        SELECT i.ticket_id, i.vendor_id, i.material_id, i.plant_code, s.ticket_owner AS own,
               s.ticket_custom_id
        FROM {{input}} i JOIN published s ON i.ticket_id = s.supplier_input_ticket_id
        ANTI JOIN {MOVED_FACT} q
          ON q.ticket_id = s.ticket_id AND q.vendor_id = i.vendor_id
          AND q.material_id = i.material_id AND q.plant_code = i.plant_code),
    tickets AS (SELECT DISTINCT ticket_id, ticket_owner FROM {{ticket}}
                WHERE ticket_status = 'Published'),
    {PLANNED},
    owned AS (
        SELECT m.*, p.vendor_name, coalesce(m.own, p.ticket_owner) AS ticket_owner
        FROM missing m JOIN tickets t ON t.ticket_id = m.ticket_id
        LEFT JOIN planned p ON p.purchase_vendor_id = m.vendor_id
          AND p.material_id = m.material_id),
    routed AS (SELECT *, {RECIPIENT} FROM owned),
    {_paged('routed', A.MISSING_COLUMNS)}""")
def _(f):
    digest = A.missing_price_digest(
        f.input, f.scale_summary, _moved_fact(f), f.ticket, f.plan, AS_OF,
        A.Routing(ADDRESS, FALLBACK))
    return _as_text(digest, A.MISSING_COLUMNS)


INPUT_COLUMNS = ["material_id", "plant_code", "vendor_id", "ticket_custom_id",
                 "supplier_input_repeats"]


@query("duplicate_input_digest", f"""
    WITH {REPEATED}, {PLANNED},
    owned AS (
        SELECT r.*, t.ticket_custom_id, coalesce(t.ticket_owner, p.ticket_owner) AS ticket_owner
        FROM repeated r
        LEFT JOIN (SELECT DISTINCT ticket_id, ticket_owner, ticket_custom_id FROM {{ticket}}) t
          ON t.ticket_id = r.ticket_id
        LEFT JOIN planned p ON p.purchase_vendor_id = r.vendor_id
          AND p.material_id = r.material_id),
    routed AS (SELECT *, {RECIPIENT} FROM owned),
    {_paged('routed', INPUT_COLUMNS)}""")
def _(f):
    digest = A.duplicate_input_digest(_delivered(f), f.ticket, f.plan,
                                      A.Routing(ADDRESS, FALLBACK))
    return _as_text(digest, INPUT_COLUMNS)


AGREEMENT_COLUMNS = ["material_id", "vendor_id", "ticket_custom_id", "prod_agr_repeats"]


@query("duplicate_agreement_digest", f"""
    WITH repeated AS (
        SELECT 'V' || CAST(l_suppkey % 10 AS STRING) AS vendor_id,
               CAST(l_partkey AS STRING) AS material_id,
               'user' || CAST(l_linenumber AS STRING) || '@example.com' AS ticket_owner,
               l_returnflag AS ticket_custom_id, count(*) AS prod_agr_repeats FROM lineitem
        GROUP BY ALL HAVING count(*) > 1),
    routed AS (SELECT *, ticket_owner AS recipient FROM repeated
               WHERE ticket_owner <> 'user3@example.com'),
    {_paged('routed', AGREEMENT_COLUMNS)}""")
def _(f):
    agreements = f.lineitem.select(
        F.concat(F.lit("V"), F.col("l_suppkey") % 10).alias("vendor_id"),
        F.col("l_partkey").cast("string").alias("material_id"),
        F.concat(F.lit("user"), "l_linenumber", F.lit("@example.com")).alias("ticket_owner"),
        F.col("l_returnflag").alias("ticket_custom_id"))
    digest = A.duplicate_agreement_digest(
        agreements, A.Routing(ADDRESS, FALLBACK, "user3@example.com"))
    return _as_text(digest, AGREEMENT_COLUMNS)
