"""Column expressions shared by the operators. All are Spark built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The credit categories that count as acting, the text shown for a
# missing death year, the minute format of the vote log.
ACTING_CATEGORIES = ("actor", "actress")
MISSING_TEXT = "----"
MINUTE_FORMAT = "dd-MM-yyyy HH-mm"

_HASH_HEX_DIGITS = 15  # 60 bits, so the value is a non-negative BIGINT


def is_acting(category: Column, acting: tuple[str, ...] = ACTING_CATEGORIES) -> Column:
    return category.isin(*acting)


def text_or_dashes(value: Column) -> Column:
    """The value as text, or dashes where it is missing."""
    return F.coalesce(value.cast("string"), F.lit(MISSING_TEXT))


def one_decimal_text(value: Column) -> Column:
    """One decimal, half up, always with a point; null stays null.

    The inner rounding removes the last-bit noise of a mean multiplied by its
    count, so that a true tie such as 7.25 is not read as 7.2499999999999991.
    """
    rounded = F.round(F.round(value, 9), 1)
    return F.when(value.isNotNull(), F.format_string("%.1f", rounded))


def number_text(value: Column) -> Column:
    return value.cast("string")


def tab_line(*columns: Column | str) -> Column:
    return F.concat_ws("\t", *columns)


def utc_time(ts: Column) -> Column:
    """A time without zone, as UTC shows it. It goes by the count of microseconds, as local times come twice a year."""
    seconds = (F.unix_micros(ts.cast("timestamp")).cast("decimal(24,6)") / 1_000_000).cast("decimal(18,6)")
    none = F.lit(0)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(none, none, none, seconds)


def utc_instant(ts: Column) -> Column:
    """The instant of a time without zone that is meant in UTC."""
    return F.concat(ts.cast("timestamp_ntz").cast("string"), F.lit("Z")).cast("timestamp")


def utc_text(ts: Column, pattern: str) -> Column:
    """A time as UTC shows it, whatever the time zone of the session."""
    return F.date_format(utc_time(ts), pattern)


def minute_text(ts: Column) -> Column:
    return utc_text(ts, MINUTE_FORMAT)


def millis_time(millis: Column) -> Column:
    """The time of a number of milliseconds since the epoch."""
    return F.timestamp_millis(millis)


def hashed_long(*columns: Column) -> Column:
    """A repeatable number in [0, 2**60) from the text of the given columns.

    MD5 rather than Spark's own hash, so that any other engine can rebuild it.
    """
    text = F.concat_ws("|", *[c.cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text), 1, _HASH_HEX_DIGITS), 16, 10).cast("bigint")
