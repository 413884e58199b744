"""Operational statistics: sweeps, calls, latencies, storage use."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from socialog.functions.clock import DAY
from socialog.operators.ordering import group_index, running_sums
from socialog.session import written


def _rows() -> Column:
    return F.count(F.lit(1))


def _share(part: Column, whole: Column) -> Column:
    """``part / whole``, 0 of nothing."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def latest_fid(shards: DataFrame) -> DataFrame:
    """Highest user id over all shards: the highest of each, then of these."""
    per_shard = shards.groupBy("shard").agg(F.max("Fid").alias("Fid"))
    return per_shard.agg(F.max("Fid").alias("latest_fid"))


def latest_fid_per_shard(shards: DataFrame) -> DataFrame:
    return shards.groupBy("shard").agg(F.max("Fid").alias("latest_fid"))


def messages_per_fid(log: DataFrame) -> DataFrame:
    return log.groupBy("Fid").agg(_rows().alias("messages"))


def sweep_summary(log: DataFrame, first: int, last: int, failed: DataFrame | None = None) -> DataFrame:
    """Ids scanned, active ids, messages and failed ids of one sweep.

    ``failed`` lists the ids whose reading failed.
    """
    scanned = first - last + 1
    per_fid = messages_per_fid(log.filter(F.col("Fid").between(last, first)))
    failures = (
        F.lit(0).cast("long")
        if failed is None
        else failed.select("Fid").distinct().agg(_rows().alias("n")).scalar()
    )
    return per_fid.agg(
        F.lit(scanned).cast("long").alias("scanned_fids"),
        _rows().alias("active_fids"),
        _total("messages").alias("messages"),
    ).withColumn("failed_fids", failures)


def progress(per_fid: DataFrame, first: int, last: int, step: int = 1000) -> DataFrame:
    """Progress of a sweep from ``first`` down to ``last``, one row per ``step`` ids.

    ``per_fid`` holds Fid, messages and elapsed_ms. At mark ``current_fid`` all
    higher ids are done. Ids are summed per mark first, so only marks are
    ordered.
    """
    spark = per_fid.sparkSession
    lowest = -(-last // step)
    marks = spark.range(lowest, -(-first // step)).select((F.col("id") * step).alias("current_fid"))
    if last % step:
        marks = marks.unionByName(spark.range(last, last + 1).select(F.col("id").alias("current_fid")))
    mark = F.greatest(F.floor((F.col("Fid") - 1) / step) * step, F.lit(last))
    done = (
        per_fid.filter(F.col("Fid").between(last + 1, first))
        .groupBy(mark.cast("long").alias("current_fid"))
        .agg(
            F.count_if(F.col("messages") > 0).alias("active_fids"),
            F.sum("messages").alias("messages"),
            F.sum("elapsed_ms").alias("elapsed_ms"),
        )
    )
    filled = marks.join(done, "current_fid", "left").select(
        F.floor(F.col("current_fid") / step).alias("_mark"),
        "current_fid",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("active_fids", "messages", "elapsed_ms")],
    )
    totals = running_sums(
        filled, "current_fid", ["active_fids", "messages", "elapsed_ms"],
        width=1000 * step, descending=True,
    ).drop("_mark")
    swept = F.lit(first) - F.col("current_fid")
    rate = F.try_divide(swept, F.col("elapsed_ms") / 1000)
    return totals.select(
        "current_fid",
        (swept * 100.0 / F.lit(max(first - last, 1))).alias("percent"),
        "active_fids",
        "messages",
        (F.col("elapsed_ms") / 1000).alias("elapsed_seconds"),
        rate.alias("fids_per_second"),
        F.try_divide(F.col("current_fid") - F.lit(last), rate).alias("remaining_seconds"),
    )


def call_statistics(calls: DataFrame) -> DataFrame:
    """Totals of a call log in one row."""
    failed = ~F.col("ok")
    return calls.agg(
        _rows().alias("total"),
        F.count_if("ok").alias("succeeded"),
        F.count_if(failed).alias("failed"),
        (_share(F.count_if("ok"), _rows()) * 100).alias("success_pct"),
        F.count_if(F.col("retries") > 0).alias("retried_calls"),
        _total("retries").alias("total_retries"),
        F.coalesce(F.max("retries"), F.lit(0)).alias("max_retries"),
    )


def key_rows(df: DataFrame, key: str) -> DataFrame:
    """(key, n): rows per value of ``key``, blank keys left out."""
    return (
        df.filter(F.col(key).isNotNull() & (F.col(key) != ""))
        .groupBy(key)
        .agg(_rows().alias("n"))
    )


def errors_by_type(calls: DataFrame) -> DataFrame:
    return key_rows(calls.filter(~F.col("ok")), "error_type")


def calls_by_context(calls: DataFrame) -> DataFrame:
    return key_rows(calls, "context")


def event_counts(events: DataFrame) -> DataFrame:
    return key_rows(events, "type")


def percentile_disc(df: DataFrame, column: str, q: float, accuracy: int = 10_000) -> float | None:
    """Exact q-quantile: the ceil(q n)-th smallest value.

    Two passes: ``percentile_approx`` brackets the value, then the values inside the
    bracket are counted, equal ones together. The counts are stored in order by range and
    the task that holds the rank is told by the sums of all tasks. Should the
    bracket ever miss, all values are counted.
    """
    values = df.select(F.col(column).alias("v")).filter(F.col("v").isNotNull())
    slack = 2.0 / accuracy
    ends = [max(q - slack, 0.0), min(q + slack, 1.0)]
    n, bracket = values.agg(
        _rows(), F.percentile_approx("v", F.array(*[F.lit(e) for e in ends]), F.lit(accuracy))
    ).first()
    if not n:
        return None
    rank = max(math.ceil(q * n), 1)
    low, high = bracket
    found = _at_rank(values.filter(F.col("v") <= high), low, rank)
    return found if found is not None else _at_rank(values, None, rank)


def _at_rank(values: DataFrame, low: float | None, rank: int) -> float | None:
    """The ``rank``-th smallest value if it is ``low`` or more; values below are counted as one."""
    held = F.col("v") if low is None else F.when(F.col("v") >= low, F.col("v"))
    counts = values.groupBy(held.alias("v")).agg(_rows().alias("n"))
    stored = written(
        counts.repartitionByRange("v").sortWithinPartitions("v").withColumn("task", F.spark_partition_id()),
        "counts",
    )
    before = 0
    # A row a task; NULL, the values below, sorts first.
    for task in stored.groupBy("task").agg(F.sum("n").alias("n")).orderBy("task").collect():
        if before + task["n"] >= rank:
            upto = F.sum("n").over(Window.partitionBy("task").orderBy("v"))
            here = stored.filter(F.col("task") == task["task"]).select("v", upto.alias("upto"))
            return here.filter(F.col("upto") >= rank - before).orderBy("upto").first()["v"]
        before += task["n"]
    return None


def latency_statistics(calls: DataFrame) -> DataFrame:
    """Minimum, average, maximum, exact P99 and calls per second in one row."""
    p99 = percentile_disc(calls, "latency_ms", 0.99)
    span = F.max("called_at") - F.min("called_at")
    return calls.agg(
        _rows().alias("calls"),
        F.min("latency_ms").alias("min_ms"),
        F.avg("latency_ms").alias("avg_ms"),
        F.max("latency_ms").alias("max_ms"),
        F.lit(p99).cast("double").alias("p99_ms"),
        F.when(span > 0, _rows() / span).otherwise(0.0).alias("calls_per_second"),
    )


def _window_p99(window: int, block: int = 4096):
    """A function for the ceil(0.99 n)-th smallest of the last n <= ``window`` values.

    Counted from the top it is one of the largest few of the window, so a
    partial sort of each window is enough. Built as a closure, it travels to
    the executors by value; they need numpy and not this package.
    """

    def p99(values: np.ndarray) -> np.ndarray:
        held = np.minimum(np.arange(1, len(values) + 1), window)
        from_top = held - np.ceil(held * 0.99).astype(int)
        keep = int(from_top.max()) + 1
        padded = np.concatenate([np.full(window - 1, -np.inf), values])
        windows = np.lib.stride_tricks.sliding_window_view(padded, window)
        found = np.empty(len(values))
        for start in range(0, len(values), block):
            part = windows[start : start + block]
            largest = np.sort(np.partition(part, window - keep, axis=1)[:, -keep:], axis=1)
            rank = from_top[start : start + block]
            found[start : start + block] = largest[np.arange(len(part)), keep - 1 - rank]
        return found

    return p99


def rolling_p99(
    calls: DataFrame,
    group: str,
    order: list[str],
    value: str,
    window: int = 1000,
    chunk: int = 20_000,
) -> DataFrame:
    """P99 of the last ``window`` values at each row, per group.

    Each group is cut into chunks of ``chunk`` rows; the last ``window - 1`` rows
    of a chunk are repeated at the head of the next, so a hot group runs as many
    tasks and every row still sees its whole window. A window function would
    rebuild and sort ``window`` values for each row; numpy selects them in place.
    Rows without a value are left out, as in ``percentile_disc``.
    """
    calls = calls.filter(F.col(value).isNotNull())
    chunk = max(chunk, window)
    numbered = group_index(calls, [group], *order, name="_n")
    here = F.floor(F.col("_n") / chunk)
    into_next = F.col("_n") % chunk > chunk - window
    spread = numbered.withColumn(
        "_chunk",
        F.explode(F.when(into_next, F.array(here, here + 1)).otherwise(F.array(here))),
    )
    schema = T.StructType([*calls.schema.fields, T.StructField("p99", T.DoubleType())])
    names, p99 = schema.names, _window_p99(window)

    def one_chunk(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_n", ignore_index=True)
        rows["p99"] = p99(rows[value].to_numpy(dtype=float))
        own = rows["_n"] // chunk == rows["_chunk"]
        return rows.loc[own, names]

    return spread.groupBy(group, "_chunk").applyInPandas(one_chunk, schema)


def recent_throughput(calls: DataFrame, group: str, at: str = "called_at", span: int = 60) -> DataFrame:
    """Events of the last ``span`` seconds at each second that has any, per group.

    Events are counted per second first. Days are worked on apart; seconds near
    the end of a day are repeated in the next.
    """
    first = calls.agg(F.min(at).alias("first")).scalar()
    seconds = calls.groupBy(group, at).agg(_rows().alias("events"))
    today, later = F.floor(F.col(at) / DAY), F.floor((F.col(at) + span) / DAY)
    spread = seconds.withColumn("_day", F.explode(F.array_distinct(F.array(today, later))))
    last = Window.partitionBy(group, "_day").orderBy(at).rangeBetween(-span, Window.currentRow)
    elapsed = F.col(at) - first
    return (
        spread.withColumn("recent", F.sum("events").over(last))
        .filter(F.floor(F.col(at) / DAY) == F.col("_day"))
        .drop("_day")
        .withColumn(
            "per_second",
            F.col("recent") / F.greatest(F.least(elapsed, F.lit(span)), F.lit(1)),
        )
    )


def filter_rate(df: DataFrame, keep: Column) -> DataFrame:
    kept = F.count_if(keep)
    return df.agg(
        _rows().alias("received"), kept.alias("kept"), _share(kept, _rows()).alias("ratio")
    )


def batch_sizes(batches: DataFrame) -> DataFrame:
    return batches.agg(
        _total("rows").alias("items"),
        _rows().alias("batches"),
        _share(F.sum("rows"), _rows()).alias("avg_batch"),
    )


def shard_counts(shards: DataFrame) -> DataFrame:
    """Messages and users of each shard; counted per user first."""
    per_fid = shards.groupBy("shard", "Fid").agg(_rows().alias("n"))
    return per_fid.groupBy("shard").agg(
        F.sum("n").alias("num_messages"), _rows().alias("num_fids")
    )


def storage_use(logs: dict[str, DataFrame]) -> DataFrame:
    """Messages held per user and store, with the earliest one."""
    rows = None
    for store, log in logs.items():
        part = log.select(F.lit(store).alias("store"), "Fid", "Timestamp", "Hash")
        rows = part if rows is None else rows.unionByName(part)
    first = F.struct("Timestamp", "Hash")
    return rows.groupBy("Fid", "store").agg(
        _rows().alias("used"),
        F.min("Timestamp").alias("earliest_timestamp"),
        F.min_by("Hash", first).alias("earliest_hash"),
    )
