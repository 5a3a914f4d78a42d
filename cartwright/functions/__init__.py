from cartwright.functions.calendar import date_key, utc_datetime
from cartwright.functions.money import money, ratio, round_half_away, to_usd
from cartwright.functions.text import clean_text, empty_to_null, lower_text, phone_text, upper_text

__all__ = [
    "clean_text",
    "date_key",
    "empty_to_null",
    "lower_text",
    "money",
    "phone_text",
    "ratio",
    "round_half_away",
    "to_usd",
    "upper_text",
    "utc_datetime",
]
