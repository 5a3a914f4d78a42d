from cartwright.operators.band import within_days
from cartwright.operators.credit import window_credit
from cartwright.operators.dense_key import dense_key, with_row_tag
from cartwright.operators.groups import flag_repeated, group_minimum, keep_latest
from cartwright.operators.lookup import lookup, lookup_number

__all__ = [
    "dense_key",
    "flag_repeated",
    "group_minimum",
    "keep_latest",
    "lookup",
    "lookup_number",
    "window_credit",
    "with_row_tag",
    "within_days",
]
