"""Protocol time: seconds since 2021-01-01 UTC.

Days and months are taken by integer arithmetic, so no result depends on the
session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = 1_609_459_200  # 2021-01-01T00:00:00Z in Unix seconds
DAY = 86_400


def to_unix(protocol: Column) -> Column:
    return protocol + F.lit(EPOCH)


def to_millis(protocol: Column) -> Column:
    return (protocol + F.lit(EPOCH)) * F.lit(1000)


def to_timestamp(protocol: Column) -> Column:
    return F.timestamp_seconds(protocol + F.lit(EPOCH))


def from_unix(unix: Column) -> Column:
    return unix - F.lit(EPOCH)


def from_timestamp(ts: Column) -> Column:
    return F.unix_seconds(ts) - F.lit(EPOCH)


def unix_of_wall_clock(ts: Column) -> Column:
    """Whole Unix seconds of a UTC ``timestamp_ntz``."""
    return (
        F.unix_date(ts.cast("date")).cast("long") * DAY
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    )


def day_of(protocol: Column) -> Column:
    """UTC calendar day as a DATE."""
    return F.date_from_unix_date(F.floor(to_unix(protocol) / DAY).cast("int"))


def month_start(protocol: Column) -> Column:
    """First day of the UTC month; group by this and format afterwards."""
    return F.trunc(day_of(protocol), "month")


def month_text(month: Column) -> Column:
    return F.date_format(month, "yyyy-MM")
