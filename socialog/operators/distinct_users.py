"""Distinct users over any span, from bitmaps.

A day's users are kept as exact bitmaps, one row for each shard, day and bucket of ids
(32 768 ids, 4 KB). Any span, shard or both is the union of such rows: days are added to
once and the log is not read again. Repeated users cost nothing, so days may
overlap and a day may be taken in twice. A bitmap row is never larger than its bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from socialog.functions import clock


def daily_users(log: DataFrame, by: Sequence[str] = (), user: str = "Fid", at: Column | None = None) -> DataFrame:
    """(*by, day, bucket, users): combined on the map side; users of NULL id are left out."""
    second = F.col("Timestamp") if at is None else at
    return (
        log.filter(F.col(user).isNotNull())
        .groupBy(
            *by,
            F.to_date(clock.to_timestamp(second)).alias("day"),
            F.bitmap_bucket_number(user).alias("bucket"),
        )
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(user)).alias("users"))
    )


def merged(*tables: DataFrame) -> DataFrame:
    """Daily tables in one, each (*by, day, bucket) once."""
    whole, *rest = tables
    for table in rest:
        whole = whole.unionByName(table)
    keys = [c for c in whole.columns if c != "users"]
    return whole.groupBy(*keys).agg(F.bitmap_or_agg("users").alias("users"))


def distinct_users(daily: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    """Number of distinct users of each group of days: filter ``daily`` to a span before.

    One row of 4 KB for each group and bucket is shuffled, however many days there are.
    """
    groups = [F.col(c) if isinstance(c, str) else c for c in by]
    named = daily.select(*groups, "bucket", "users")
    names = [c for c in named.columns if c not in ("bucket", "users")]
    return (
        named.groupBy(*names, "bucket")
        .agg(F.bitmap_count(F.bitmap_or_agg("users")).alias("n"))
        .groupBy(*names)
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("users"))
    )
