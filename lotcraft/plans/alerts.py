"""Data-quality alerts and reminders, one job each, ready for a mail sender to read."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from lotcraft.operators import quality as Q

MISSING_COLUMNS = ["material_id", "plant_code", "vendor_id", "vendor_name", "ticket_custom_id"]
INPUT_KEYS = ["material_id", "plant_code", "vendor_id", "ticket_id"]
AGREEMENT_KEYS = ["vendor_id", "material_id", "ticket_owner", "ticket_custom_id"]


@dataclass(frozen=True)
class Routing:
    """Whose address is valid, who else gets the mail, and who never does."""

    pattern: str
    fallback: str
    excluded_owner: str | None = None


def _digest(df: DataFrame, routing: Routing, columns: Sequence[str]) -> DataFrame:
    routed = Q.route_recipient(df, routing.pattern, routing.fallback, routing.excluded_owner)
    return Q.digest_by_recipient(routed, columns, by=["recipient", "ticket_owner",
                                                      "is_valid_owner"])


def missing_quotation_digest(
    inp: DataFrame, summary: DataFrame, fact: DataFrame, trig: DataFrame, plan: DataFrame,
    as_of: dt.date, routing: Routing,
) -> DataFrame:
    missing = Q.missing_quotation(inp, Q.recently_published(summary, as_of), fact)
    owned = Q.resolve_owner(missing, trig, plan,
                            carry=["ticket_custom_id", "quotation_summary_ticket_id"])
    return _digest(owned, routing, MISSING_COLUMNS)


def missing_price_digest(
    inp: DataFrame, summary: DataFrame, fact: DataFrame, trig: DataFrame, plan: DataFrame,
    as_of: dt.date, routing: Routing,
) -> DataFrame:
    own = "ticket_owner_from_price_scale_summary"
    missing = Q.missing_price(inp, Q.recently_published(summary, as_of), fact)
    owned = Q.resolve_owner(missing, trig, plan,
                            carry=["ticket_custom_id", "price_summary_ticket_id", own],
                            own_owner=own)
    return _digest(owned, routing, MISSING_COLUMNS)


def duplicate_input_digest(
    inp: DataFrame, trig: DataFrame, plan: DataFrame, routing: Routing
) -> DataFrame:
    repeated = Q.duplicate_keys(inp, INPUT_KEYS, "supplier_input_repeats")
    owned = Q.resolve_owner(repeated, trig, plan, carry=["supplier_input_repeats"], status=None,
                            trigger_columns=["ticket_custom_id"])
    return _digest(owned, routing, ["material_id", "plant_code", "vendor_id", "ticket_custom_id",
                                    "supplier_input_repeats"])


def duplicate_agreement_digest(agreements: DataFrame, routing: Routing) -> DataFrame:
    repeated = Q.duplicate_keys(agreements, AGREEMENT_KEYS, "prod_agr_repeats")
    return _digest(repeated, routing,
                   ["material_id", "vendor_id", "ticket_custom_id", "prod_agr_repeats"])
