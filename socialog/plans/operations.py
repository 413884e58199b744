"""Operational statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from socialog.operators import operations as op
from socialog.plans import fixtures as fx
from socialog.plans.catalog import query


def _rounded(df, *columns: str):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("latest_fid", "SELECT max(Fid) AS latest_fid FROM shards", ("shards",))
def _(spark, sf):
    return op.latest_fid(fx.shards(spark, sf))


@query(
    "latest_fid_per_shard",
    "SELECT shard, max(Fid) AS latest_fid FROM shards GROUP BY shard",
    ("shards",),
)
def _(spark, sf):
    return op.latest_fid_per_shard(fx.shards(spark, sf))


@query(
    "sweep_summary",
    """SELECT CAST(1000 AS BIGINT) AS scanned_fids, count(DISTINCT Fid) AS active_fids,
              count(*) AS messages,
              (SELECT count(DISTINCT user_id) FROM events WHERE event_type = 'error') AS failed_fids
       FROM reactions WHERE Fid BETWEEN 1 AND 1000""",
    ("reactions",),
)
def _(spark, sf):
    failed = fx.table(spark, sf, "events").filter("event_type = 'error'")
    return op.sweep_summary(
        fx.reactions(spark, sf), 1000, 1, failed.select(F.col("user_id").alias("Fid"))
    )


@query("messages_per_fid", "SELECT Fid, count(*) AS messages FROM casts GROUP BY Fid", ("casts",))
def _(spark, sf):
    return op.messages_per_fid(fx.casts(spark, sf))


@query(
    "sweep_progress",
    """SELECT m.current_fid,
              round((first - m.current_fid) * 100.0 / (first - 1), 6) AS percent,
              count(*) FILTER (messages > 0) AS active_fids,
              CAST(coalesce(sum(messages), 0) AS BIGINT) AS messages,
              round(coalesce(sum(elapsed_ms), 0) / 1000, 6) AS elapsed_seconds,
              round((first - m.current_fid) / nullif(sum(elapsed_ms) / 1000, 0), 6) AS fids_per_second,
              round((m.current_fid - 1) * (sum(elapsed_ms) / 1000) / (first - m.current_fid), 6)
                  AS remaining_seconds
       FROM (SELECT max(Fid) AS first FROM sweep_log) s
       JOIN (SELECT unnest(list_append(range(10, 1000000, 10), 1)) AS current_fid) m
         ON m.current_fid < s.first
       LEFT JOIN sweep_log l ON l.Fid > m.current_fid
       GROUP BY m.current_fid, first""",
    ("sweep_log",),
)
def _(spark, sf):
    log = fx.sweep_log(spark, sf)
    first = log.agg(F.max("Fid")).first()[0]
    return _rounded(
        op.progress(log, first, 1, step=10),
        "percent", "elapsed_seconds", "fids_per_second", "remaining_seconds",
    )


@query(
    "call_statistics",
    """SELECT count(*) AS total, count(*) FILTER (ok) AS succeeded,
              count(*) FILTER (NOT ok) AS failed,
              round(count(*) FILTER (ok) * 100.0 / count(*), 6) AS success_pct,
              count(*) FILTER (retries > 0) AS retried_calls,
              CAST(sum(retries) AS BIGINT) AS total_retries, max(retries) AS max_retries
       FROM calls""",
    ("calls",),
)
def _(spark, sf):
    return _rounded(op.call_statistics(fx.calls(spark, sf)), "success_pct")


@query(
    "errors_by_type",
    "SELECT error_type, count(*) AS n FROM calls WHERE NOT ok GROUP BY 1",
    ("calls",),
)
def _(spark, sf):
    return op.errors_by_type(fx.calls(spark, sf))


@query(
    "calls_by_context",
    "SELECT context, count(*) AS n FROM calls GROUP BY 1",
    ("calls",),
)
def _(spark, sf):
    return op.calls_by_context(fx.calls(spark, sf))


@query(
    "event_counts_by_type",
    "SELECT type, count(*) AS n FROM stream_events GROUP BY 1",
    ("stream_events",),
)
def _(spark, sf):
    return op.event_counts(fx.events(spark, sf))


@query(
    "latency_statistics",
    """SELECT count(*) AS calls, min(latency_ms) AS min_ms, round(avg(latency_ms), 6) AS avg_ms,
              max(latency_ms) AS max_ms, quantile_disc(latency_ms, 0.99) AS p99_ms,
              round(count(*) / (max(called_at) - min(called_at)), 6) AS calls_per_second
       FROM calls""",
    ("calls",),
)
def _(spark, sf):
    return _rounded(op.latency_statistics(fx.calls(spark, sf)), "avg_ms", "calls_per_second")


@query(
    "rolling_p99",
    """SELECT context, event_id, latency_ms,
              quantile_disc(latency_ms, 0.99) OVER (PARTITION BY context ORDER BY called_at, event_id
                  ROWS BETWEEN 999 PRECEDING AND CURRENT ROW) AS p99
       FROM calls""",
    ("calls",),
)
def _(spark, sf):
    rows = fx.calls(spark, sf).select("context", "event_id", "called_at", "latency_ms")
    return op.rolling_p99(rows, "context", ["called_at", "event_id"], "latency_ms").drop("called_at")


@query(
    "recent_throughput",
    """SELECT context, called_at, events, CAST(recent AS BIGINT) AS recent,
              round(recent / greatest(least(called_at - (SELECT min(called_at) FROM calls), 60), 1), 6) AS per_second
       FROM (SELECT *, sum(events) OVER (PARTITION BY context ORDER BY called_at
                        RANGE BETWEEN 60 PRECEDING AND CURRENT ROW) AS recent
             FROM (SELECT context, called_at, count(*) AS events FROM calls GROUP BY 1, 2))""",
    ("calls",),
)
def _(spark, sf):
    return _rounded(op.recent_throughput(fx.calls(spark, sf), "context"), "per_second")


@query(
    "filter_rate",
    """SELECT count(*) AS received, count(*) FILTER (message_kind IN ('CastAdd', 'CastRemove')) AS kept,
              round(count(*) FILTER (message_kind IN ('CastAdd', 'CastRemove')) / count(*), 6) AS ratio
       FROM stream_events""",
    ("stream_events",),
)
def _(spark, sf):
    kind = F.col("merge_message_body.message.data.type")
    keep = (F.col("type") == "MERGE_MESSAGE") & kind.isin("CastAdd", "CastRemove")
    return _rounded(op.filter_rate(fx.events(spark, sf), keep), "ratio")


@query(
    "batch_sizes",
    """SELECT CAST(sum(rows) AS BIGINT) AS items, count(*) AS batches,
              round(sum(rows) / count(*), 6) AS avg_batch FROM batch_log""",
    ("batch_log",),
)
def _(spark, sf):
    return _rounded(op.batch_sizes(fx.batch_log(spark, sf)), "avg_batch")


@query(
    "shard_counts",
    "SELECT shard, count(*) AS num_messages, count(DISTINCT Fid) AS num_fids FROM shards GROUP BY 1",
    ("shards",),
)
def _(spark, sf):
    return op.shard_counts(fx.shards(spark, sf))


_STORES = {"CASTS": "casts", "LINKS": "links", "REACTIONS": "reactions", "USER_DATA": "profiles"}


@query(
    "storage_use",
    "SELECT Fid, store, count(*) AS used, min(Timestamp) AS earliest_timestamp, "
    "arg_min(Hash, row(Timestamp, Hash)) AS earliest_hash FROM ("
    + " UNION ALL ".join(
        f"SELECT '{store}' AS store, Fid, Timestamp, Hash FROM {kind}"
        for store, kind in _STORES.items()
    )
    + ") GROUP BY 1, 2",
    tuple(_STORES.values()),
)
def _(spark, sf):
    return op.storage_use({store: fx.FLAT[kind](spark, sf) for store, kind in _STORES.items()})
