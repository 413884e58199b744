"""Row filters. Bounds are literals, so they reach the Parquet scan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from socialog.functions.clock import DAY, EPOCH, to_millis

FUTURE_SLACK = DAY


def cutoff(now: int, days: int) -> int:
    """Oldest protocol second kept by ``last_days``."""
    return now - days * DAY - EPOCH


def latest_allowed(now: int) -> int:
    """Newest protocol second kept by ``not_future``: one day of clock skew."""
    return now - EPOCH + FUTURE_SLACK


def last_days(log: DataFrame, days: int, now: int) -> DataFrame:
    return log.filter(F.col("Timestamp") >= cutoff(now, days))


def not_future(log: DataFrame, now: int) -> DataFrame:
    return log.filter(F.col("Timestamp") <= latest_allowed(now))


def time_filter_counts(log: DataFrame, now: int, days: int) -> DataFrame:
    """Retrieved, too old, in the future and kept, in one pass."""
    ts = F.col("Timestamp")
    old, future = ts < cutoff(now, days), ts > latest_allowed(now)
    return log.agg(
        F.count(F.lit(1)).alias("retrieved"),
        F.count_if(old).alias("too_old"),
        F.count_if(~old & future).alias("in_future"),
        F.count_if(~old & ~future).alias("kept"),
    )


def of_fid(log: DataFrame, fid: int) -> DataFrame:
    return log.filter(F.col("Fid") == fid)


def of_types(log: DataFrame, types: Iterable[str], column: str = "MessageType") -> DataFrame:
    return log.filter(F.col(column).isin(*types))


def of_fids(
    df: DataFrame, allowed: Iterable[int] | DataFrame, column: str | Column = "Fid"
) -> DataFrame:
    """Rows of the listed users; an empty list keeps everything.

    A list becomes an IN set of any length; a table becomes a semi join whose
    strategy Spark picks from the measured size.
    """
    key = F.col(column) if isinstance(column, str) else column
    if isinstance(allowed, DataFrame):
        if allowed.isEmpty():
            return df
        listed = allowed.select(F.col(allowed.columns[0]).alias("_allowed"))
        return df.join(listed, key == F.col("_allowed"), "left_semi")
    fids = sorted(set(allowed))
    return df.filter(key.isin(fids)) if fids else df


def merged_messages(events: DataFrame) -> DataFrame:
    """Merge events that carry message data."""
    return events.filter(
        (F.col("type") == "MERGE_MESSAGE")
        & F.col("merge_message_body.message.data").isNotNull()
    )


def latency_ms(processed_at: str = "processed_at", timestamp: str = "timestamp") -> Column:
    return F.col(processed_at) - to_millis(F.col(timestamp))


def fresh(events: DataFrame, max_age_ms: int = 60_000, timestamp: str = "timestamp") -> DataFrame:
    """Drop events older than ``max_age_ms`` when processed."""
    return events.filter(latency_ms(timestamp=timestamp) <= max_age_ms)


def text_match(
    df: DataFrame, column: str, pattern: str, order: list[str], limit: int = 100
) -> DataFrame:
    return df.filter(F.col(column).like(pattern)).orderBy(*order).limit(limit)


def between_times(log: DataFrame, fid: int, start: int, stop: int) -> DataFrame:
    return log.filter((F.col("Fid") == fid) & F.col("Timestamp").between(start, stop))


def is_complete() -> Column:
    """A message with data and a non-empty hash."""
    return F.coalesce(F.col("data").isNotNull() & (F.length("hash") > 0), F.lit(False))


def complete(messages: DataFrame) -> DataFrame:
    return messages.filter(is_complete())


def completeness(messages: DataFrame) -> DataFrame:
    return messages.agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(is_complete()).alias("good"),
        F.count_if(~is_complete()).alias("bad"),
    )
