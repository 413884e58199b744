"""The whole runs: messages to log, log to state tables, members, live delivery."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from socialog.operators import filters, normalize, state
from socialog.session import sized_shuffles
from socialog.sources import schemas, sinks, tables
from socialog.streaming import delivery

STATE = {
    "casts": state.live_casts,
    "reactions": state.live_reactions,
    "links": state.live_links,
    "profiles": state.wide_profiles,
}


def wanted_messages(
    messages: DataFrame,
    kind: str,
    now: int,
    fid: int | None = None,
    days: int | None = None,
) -> DataFrame:
    """Messages of one kind, not from the future, of one user or of the last days if asked.

    All bounds are on plain nested columns, so they reach the scan; a message
    without a time passes the time filters. A message without data is of no kind and
    is kept, as ``Unknown``, by a run over all users.
    """
    types = schemas.MESSAGE_TYPES[kind]
    kept = messages.filter(F.col("data.type").isin(*types) | F.col("data").isNull())
    at = F.col("data.timestamp")
    kept = kept.filter(at.isNull() | (at <= filters.latest_allowed(now)))
    if days is not None:
        kept = kept.filter(at.isNull() | (at >= filters.cutoff(now, days)))
    if fid is not None:
        kept = kept.filter(F.col("data.fid") == fid)
    return kept


def write_log(
    spark: SparkSession,
    source: str,
    root: str,
    kind: str,
    now: int,
    fid: int | None = None,
    days: int | None = None,
    profile: str = "high_throughput",
) -> int:
    """Messages below ``source`` to the flat log of one kind; returns the rows written.

    One stage without a shuffle; the rows are counted while they are written.
    """
    counted = Observation()
    rows = (
        wanted_messages(tables.scan_messages(spark, source), kind, now, fid, days)
        .transform(normalize.FLATTEN[kind])
        .observe(counted, F.count(F.lit(1)).alias("rows"))
    )
    sinks.write_tuned(rows, f"{root}/{kind}/{kind}_messages", profile)
    return counted.get["rows"]


def export_state(spark: SparkSession, root: str, kind: str, target: str) -> None:
    """Current-state table of one kind as ZSTD Parquet, its shuffles sized by the log."""
    with sized_shuffles(spark, f"{root}/{kind}/{kind}_messages"):
        sinks.export_zstd(STATE[kind](tables.scan_kind(spark, root, kind)), target)


def export_pro_members(
    tiers: DataFrame, verifications: DataFrame, now: int, target: str
) -> None:
    """Active pro members and their addresses as CSV."""
    sinks.write_csv(state.pro_members(tiers, verifications, now), target)


def listen(
    spark: SparkSession,
    source: str,
    queues: str,
    position: str,
    fids: Iterable[int] = (),
    types: Iterable[str] = delivery.DEFAULT_TYPES,
    every_ms: int | None = delivery.BATCH_MILLIS,
) -> StreamingQuery:
    """Deliver new events to the queues; the time of processing is the batch's own."""
    events = delivery.file_events(spark, source)
    now = F.unix_millis(F.current_timestamp())
    rows = delivery.normalized(events, types, fids, processed_at=now)
    return delivery.deliver(delivery.to_queue_rows(rows), queues, position, every_ms)
