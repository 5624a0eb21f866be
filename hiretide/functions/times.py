"""Times as text, as days and as wall clock, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_text(ts: Column) -> Column:
    """ISO-8601 text of an instant, with offset; the fraction is left out when it is zero."""
    return F.replace(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"), F.lit(".000000"),
                     F.lit(""))


def clock_iso_text(ts: Column) -> Column:
    """ISO-8601 text of a wall-clock time that is UTC."""
    return F.concat(F.replace(ts.cast("string"), F.lit(" "), F.lit("T")), F.lit("+00:00"))


def utc_day(ts: Column) -> Column:
    """The UTC calendar day of an instant."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / 86400).cast("int"))


def utc_hour(ts: Column) -> Column:
    """The hour of the UTC day of an instant."""
    return F.floor(F.pmod(F.unix_seconds(ts), F.lit(86400)) / 3600).cast("int")


def utc_clock(ts: Column) -> Column:
    """UTC wall-clock time of an instant, without a time zone."""
    seconds = F.unix_micros(ts).cast("decimal(20,0)") / F.lit(1_000_000)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
