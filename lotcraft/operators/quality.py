"""Duplicate, mismatch and deadline checks, and their routing to recipients."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotcraft.functions import id_number, left_padded
from lotcraft.functions.columns import MATERIAL_WIDTH, VENDOR_WIDTH
from lotcraft.sources.staging import cut_lineage

PAGE_ROWS = 100
PUBLISHED = "Published"
AWAITING = "awaiting for supplier%"
REMINDER_EVERY = 3
REMINDER_KEYS = ["vendor_id", "supplier_deadline_date", "ticket_status", "ticket_id"]


def duplicate_keys(df: DataFrame, keys: Sequence[str], out: str = "repeats") -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) > 1)


def _linked_input(inp: DataFrame, summary: DataFrame, extra: Sequence[str]) -> DataFrame:
    side = summary.select(
        F.col("supplier_input_ticket_id").alias("ticket_id"),
        F.col("ticket_id").alias("summary_ticket_id"),
        *extra,
    )
    return inp.select("ticket_id", "vendor_id", "material_id", "plant_code").join(side, "ticket_id")


def missing_quotation(inp: DataFrame, summary: DataFrame, fact: DataFrame) -> DataFrame:
    """Input rows whose quotation ticket has no fact for their vendor, material and plant."""
    keys = ["summary_ticket_id", "vendor_id", "material_id", "plant_code"]
    quoted = fact.select(F.col("ticket_id").alias("summary_ticket_id"), *keys[1:]).distinct()
    linked = _linked_input(inp, summary, ["ticket_custom_id"])
    return linked.join(quoted, keys, "left_anti").select(
        "ticket_id", "vendor_id", "material_id", "plant_code",
        F.col("summary_ticket_id").alias("quotation_summary_ticket_id"), "ticket_custom_id",
    )


def missing_price(inp: DataFrame, summary: DataFrame, fact: DataFrame) -> DataFrame:
    """As `missing_quotation` for price scales: ids compared as numbers, owner of the summary."""
    keys = ["summary_ticket_id", "_vendor", "_material", "plant_code"]
    ids = [id_number("vendor_id").alias("_vendor"), id_number("material_id").alias("_material")]
    scaled = fact.select(F.col("ticket_id").alias("summary_ticket_id"), *ids, "plant_code")
    linked = _linked_input(inp, summary, ["ticket_owner", "ticket_custom_id"]).select("*", *ids)
    return linked.join(scaled.distinct(), keys, "left_anti").select(
        "ticket_id", "vendor_id", "material_id", "plant_code",
        F.col("summary_ticket_id").alias("price_summary_ticket_id"),
        F.col("ticket_owner").alias("ticket_owner_from_price_scale_summary"), "ticket_custom_id",
    )


def recently_published(
    df: DataFrame,
    as_of: dt.date,
    days: int = 7,
    status: str = PUBLISHED,
    modified: str = "modified_date",
) -> DataFrame:
    """Published tickets changed less than `days` days before `as_of`, or after it."""
    age = F.datediff(F.lit(as_of), F.col(modified).try_cast("date"))
    return df.filter((age < days) & (F.col("ticket_status") == status))


def resolve_owner(
    rows: DataFrame,
    trig: DataFrame,
    plan: DataFrame,
    carry: Sequence[str] = ("ticket_custom_id",),
    own_owner: str | None = None,
    status: str | None = PUBLISHED,
    trigger_columns: Sequence[str] = (),
) -> DataFrame:
    """Owner of each row: its ticket's, or that of `own_owner`, else the planning owner.

    With a `status` only rows whose ticket has it remain. The planning side matches on the
    padded vendor and material, and a row is repeated for every distinct ticket, owner and
    vendor name it finds there.
    """
    sought = [] if status is None else ["ticket_status"]
    tickets = trig.select(
        "ticket_id", F.col("ticket_owner").alias("_ticket_owner"), *sought, *trigger_columns
    ).distinct()
    if status is not None:
        joined = rows.join(
            tickets.filter(F.col("ticket_status") == status).drop("ticket_status"), "ticket_id"
        )
    else:
        joined = rows.join(tickets, "ticket_id", "left")

    planned = plan.select(
        F.col("purchase_vendor_id").alias("_vendor"), F.col("material_id").alias("_material"),
        F.col("ticket_id").alias("_plan_ticket"), F.col("ticket_owner").alias("_plan_owner"),
        "vendor_name",
    ).distinct()
    keyed = joined.withColumns(
        {"_vendor": left_padded("vendor_id", VENDOR_WIDTH),
         "_material": left_padded("material_id", MATERIAL_WIDTH)}
    )
    first = F.col(own_owner) if own_owner else F.col("_ticket_owner")
    return keyed.join(planned, ["_vendor", "_material"], "left").select(
        "material_id", "plant_code", "vendor_id", "vendor_name", "ticket_id",
        F.coalesce(first, F.col("_plan_owner")).alias("ticket_owner"),
        *carry, *[c for c in trigger_columns if c not in carry],
    )


def route_recipient(
    df: DataFrame,
    pattern: str,
    fallback: str,
    excluded_owner: str | None = None,
    owner: str = "ticket_owner",
) -> DataFrame:
    """Recipient of each row: the owner when the whole text is an address, else `fallback`.

    Excluding an owner also drops rows without one, as the comparison is null there.
    """
    kept = df if excluded_owner is None else df.filter(F.col(owner) != excluded_owner)
    valid = F.coalesce(F.col(owner).rlike(f"^(?:{pattern})$"), F.lit(False))
    return kept.withColumn("is_valid_owner", valid).withColumn(
        "recipient", F.when(valid, F.col(owner)).otherwise(fallback)
    )


def digest_by_recipient(
    df: DataFrame,
    cols: Sequence[str],
    page_rows: int = PAGE_ROWS,
    by: Sequence[str] = ("recipient", "ticket_owner"),
) -> DataFrame:
    """All rows per recipient and owner on pages of at most `page_rows` different rows.

    Equal rows are counted before the shuffle and shown once, with their `copies`. The counted
    rows are written, so that totals and pages read them and not the input again. A row's hash
    chooses one of as many spots as full pages would need; what a spot holds beyond one page
    goes to further ones, so no task orders more than the few rows of a spot. Every page has
    the recipient's `rows_total`, copies included.
    """
    by, cols = list(by), list(cols)
    counted = cut_lineage(df.groupBy(*by, *cols).agg(F.count(F.lit(1)).alias("copies")), "digest")
    totals = counted.groupBy(*by).agg(
        F.sum("copies").alias("rows_total"),
        F.ceil(F.count(F.lit(1)) / page_rows).alias("_spots"),
    )
    same = F.lit(True)
    for key in by:
        same = same & F.col(f"c.{key}").eqNullSafe(F.col(f"t.{key}"))
    rows = counted.alias("c").join(totals.alias("t"), same).select(
        *[F.col(f"c.{k}").alias(k) for k in [*by, *cols, "copies"]], "t.rows_total", "t._spots"
    )
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    code = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    order = Window.partitionBy(*by, "_spot").orderBy(*[F.asc(c) for c in cols])
    turn = F.floor((F.row_number().over(order) - 1) / page_rows)
    return (
        rows.withColumn("_spot", code % F.col("_spots"))
        .withColumn("page", F.col("_spot") + F.col("_spots") * turn)
        .groupBy(*by, "rows_total", "_spot", "page")
        .agg(F.sort_array(F.collect_list(F.struct(*cols, "copies"))).alias("rows_shown"))
        .drop("_spot")
    )


def is_overdue(as_of: dt.date, deadline: str) -> Column:
    """Ticket waits for its supplier and the deadline has passed."""
    late = F.datediff(F.lit(as_of), F.col(deadline).try_cast("date")) > 0
    return F.lower("ticket_status").like(AWAITING) & late


def join_history(summary: DataFrame, history: DataFrame, deadline: str) -> DataFrame:
    """Each ticket with the counter of its last reminder, null when it had none."""
    state = history.select(
        "vendor_id", "ticket_id", "ticket_status",
        F.col("supplier_deadline_date").cast("date").alias("_deadline"), "last_reminder",
    )
    keyed = summary.withColumn("_deadline", F.col(deadline).try_cast("date"))
    return keyed.join(
        state, ["vendor_id", "ticket_id", "ticket_status", "_deadline"], "left"
    ).drop("_deadline")


def is_business_day(as_of: dt.date | str | Column) -> Column:
    """Monday to Friday."""
    day = F.lit(as_of) if isinstance(as_of, dt.date) else (
        F.col(as_of) if isinstance(as_of, str) else as_of
    )
    return F.weekday(day) < 5


def overdue_reminders(
    summary: DataFrame,
    vendor: DataFrame,
    history: DataFrame,
    as_of: dt.date,
    deadline: str = "supplier_deadline_date",
    addresses: Sequence[str] = ("ticket_owner", "supplier_email"),
    extra: Sequence[str] = ("ticket_title",),
    every: int = REMINDER_EVERY,
) -> DataFrame:
    """Reminders due on `as_of`, none on a weekend: overdue tickets, every third run, with
    all addresses known."""
    due = summary.filter(is_overdue(as_of, deadline) & is_business_day(as_of))
    names = vendor.select(id_number("vendor_id").alias("_vendor"), "vendor_name")
    counter = F.coalesce(F.col("last_reminder"), F.lit(0))
    recipients = F.concat(*[
        part for i, a in enumerate(addresses)
        for part in ([F.lit(";")] if i else []) + [F.col(a)]
    ])
    return (
        join_history(due, history, deadline)
        .withColumn("_vendor", id_number("vendor_id"))
        .join(names, "_vendor", "left")
        .withColumns({
            "last_reminder": counter,
            "sent_emails": recipients,
            "days_overdue": F.datediff(F.lit(as_of), F.col(deadline).try_cast("date")),
        })
        .filter((F.col("last_reminder") % every == 0) & F.col("sent_emails").isNotNull())
        .select("vendor_id", "vendor_name", "supplier_email", deadline, "days_overdue",
                "ticket_status", "ticket_id", *extra, "ticket_owner", "last_reminder",
                "sent_emails")
    )
