from lotcraft.functions.columns import (
    blank_to_null,
    equals_ignoring_case,
    fiscal_year,
    id_number,
    is_blank,
    left_padded,
    pad_left_keep_left,
    pad_left_keep_right,
    parsed_number,
    region_code,
    settled_round,
    strip_leading_zeros,
)
from lotcraft.functions.grouping import (
    attach_group_values,
    attach_lookup,
    group_values,
    latest_in_group,
    one_row_per_group,
    unique_rows_only,
)

__all__ = [
    "attach_group_values",
    "attach_lookup",
    "blank_to_null",
    "equals_ignoring_case",
    "fiscal_year",
    "group_values",
    "id_number",
    "is_blank",
    "latest_in_group",
    "left_padded",
    "one_row_per_group",
    "pad_left_keep_left",
    "pad_left_keep_right",
    "parsed_number",
    "region_code",
    "settled_round",
    "strip_leading_zeros",
    "unique_rows_only",
]
