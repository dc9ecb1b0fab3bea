from marquee.functions.scalars import (
    hashed_long,
    is_acting,
    millis_time,
    minute_text,
    number_text,
    one_decimal_text,
    tab_line,
    text_or_dashes,
    utc_instant,
    utc_text,
    utc_time,
)

__all__ = [
    "hashed_long",
    "is_acting",
    "millis_time",
    "minute_text",
    "number_text",
    "one_decimal_text",
    "tab_line",
    "text_or_dashes",
    "utc_instant",
    "utc_text",
    "utc_time",
]
