"""Text-to-value cleaning that never throws under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def drop_nan(c: Column) -> Column:
    """NaN to null. Spark orders NaN above every number, so `NaN >= 0` would hold."""
    return F.nanvl(c, F.lit(None).cast("double"))


def clean_double(c: Column) -> Column:
    """Text to double; bad text, null markers and NaN become null.

    A Java type suffix, as in `1.5d`, is bad text here although Spark's cast would take it.
    """
    text = c.cast("string")
    return drop_nan(F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), text).try_cast("double"))


def clean_text(c: Column) -> Column:
    """Lower case, without white space of any kind at either end."""
    return F.lower(F.regexp_replace(c.cast("string"), r"(?U)^\s+|\s+$", ""))


def utc_timestamp(date: Column, hhmm: Column) -> Column:
    """Date text and an HHMM number (5 is 00:05, 518 is 05:18) to a UTC timestamp, else null.

    The time is read as a number first, so a float-typed 518.0 is 05:18 as well; of more than
    four digits the first four count. A date with a time part is bad text.
    """
    text = date.cast("string")
    day = F.when(text.rlike(r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\s*$"), text).try_cast("date")
    number = F.lpad(hhmm.cast("string").try_cast("decimal(9,2)").cast("int").cast("string"), 4, "0").try_cast("int")
    # 60 h + m minutes out of 100 h + m.
    minutes = number - F.floor(number / 100) * 40
    valid = number.between(0, 2359) & (number % 100 < 60)
    return F.when(valid, F.timestamp_seconds((F.unix_date(day).cast("long") * 1440 + minutes) * 60))


def shift_hours(ts: Column, hours: int) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(hours))


def clip(c: Column, low=None, high=None) -> Column:
    """Clamp, keeping null: greatest and least alone would skip the null and return the bound."""
    out = c
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(c.isNotNull(), out)


def file_prefix(file_name: Column) -> Column:
    """`riau_20240101_UTC.csv` to `riau`."""
    return F.split(file_name, "_")[0]
