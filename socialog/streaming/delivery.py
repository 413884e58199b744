"""Event stream in, normalised casts out.

Spark's checkpoint is the resumable position. Source, filter, normalise, age
filter and JSON run on the executors without a shuffle; only the redelivery
guard and the windowed counts keep state.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from socialog.functions import clock, labels
from socialog.operators import filters
from socialog.operators.normalize import normalize_events
from socialog.sources import schemas

# Message kinds followed by default and the batch bounds.
DEFAULT_TYPES = ("CastAdd", "CastRemove")
BATCH_MILLIS = 100
INTAKE_EVENTS = 10_000
MAX_AGE_MS = 60_000

ADD_QUEUE = "casts_add"
REMOVE_QUEUE = "casts_remove"

# Columns of the JSON value, in order.
VALUE_FIELDS = (
    "fid", "hash", "timestamp", "text", "embeds", "mentions", "mentions_positions",
    "parent_hash", "parent_url", "event_id", "message_type", "target_hash", "processed_at",
)
VALUE_SCHEMA = (
    "fid bigint, hash string, timestamp bigint, text string, "
    "embeds array<struct<url: string, cast_id: struct<fid: bigint, hash: string>>>, "
    "mentions array<bigint>, mentions_positions array<bigint>, parent_hash string, "
    "parent_url string, event_id bigint, message_type string, target_hash string, "
    "processed_at bigint"
)


def file_events(
    spark: SparkSession,
    folder: str,
    start_id: int | None = None,
    types: Iterable[str] = (),
    max_files: int = 1000,
    shard: int | None = None,
) -> DataFrame:
    """Event stream over Parquet files, from ``start_id`` on.

    ``max_files`` bounds a micro-batch, which is the intake limit.
    """
    events = (
        spark.readStream.schema(schemas.EVENT).option("maxFilesPerTrigger", max_files).parquet(folder)
    )
    return from_position(events, start_id, types, shard)


def kafka_events(
    spark: SparkSession,
    servers: str,
    topic: str,
    max_offsets: int = INTAKE_EVENTS,
    starting: str = "latest",
) -> DataFrame:
    """Event stream from Kafka as JSON values; needs Spark's Kafka package."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("maxOffsetsPerTrigger", max_offsets)
        .load()
    )
    value = F.from_json(F.col("value").cast("string"), schemas.EVENT)
    return raw.select(value.alias("event")).select("event.*")


def from_position(
    events: DataFrame,
    start_id: int | None = None,
    types: Iterable[str] = (),
    shard: int | None = None,
) -> DataFrame:
    """Events past ``start_id`` of the given event types (all when empty) and shard."""
    if shard is not None:
        events = events.filter(F.col("shard_index") == shard)
    if start_id is not None:
        events = events.filter(F.col("id") > start_id)
    types = list(types)
    return events.filter(F.col("type").isin(types)) if types else events


def newest_id(events: DataFrame) -> int:
    """Where to start when there is no position: the highest id, or 0."""
    return events.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]


def start_id(events: DataFrame, positions: DataFrame | None = None) -> int:
    """Last delivered id, else the newest id of the source."""
    if positions is not None:
        last = positions.agg(F.max("event_id")).first()[0]
        if last is not None:
            return last
    return newest_id(events)


def wanted(
    events: DataFrame,
    types: Iterable[str] = DEFAULT_TYPES,
    fids: Iterable[int] | DataFrame = (),
) -> DataFrame:
    """Merge events of the wanted message types and users."""
    data = "merge_message_body.message.data"
    merged = filters.of_types(filters.merged_messages(events), types, f"{data}.type")
    return filters.of_fids(merged, fids, F.col(f"{data}.fid"))


def normalized(
    events: DataFrame,
    types: Iterable[str] = DEFAULT_TYPES,
    fids: Iterable[int] | DataFrame = (),
    max_age_ms: int = MAX_AGE_MS,
    processed_at: Column | None = None,
) -> DataFrame:
    """Filter, normalise, drop old events, and add both latencies and the queue.

    ``processed_at`` (milliseconds) replaces the column of that name; pass
    ``unix_millis(current_timestamp())`` on a live stream.
    """
    if processed_at is not None:
        events = events.withColumn("processed_at", processed_at)
    recent = filters.fresh(wanted(events, types, fids), max_age_ms)
    return (
        normalize_events(recent)
        .withColumn("latency_ms", filters.latency_ms(timestamp="event_timestamp"))
        .withColumn("cast_latency_ms", filters.latency_ms(timestamp="timestamp"))
        .withColumn("latency_band", labels.latency_band(F.col("latency_ms")))
        .withColumn(
            "queue",
            F.when(F.col("message_type") == "cast_add", ADD_QUEUE).otherwise(REMOVE_QUEUE),
        )
    )


def to_queue_rows(casts: DataFrame) -> DataFrame:
    """(queue, event_id, value): the JSON of a normalised cast, NULLs left out."""
    return casts.select(
        "queue", "event_id", F.to_json(F.struct(*VALUE_FIELDS)).alias("value")
    )


def from_queue_rows(rows: DataFrame) -> DataFrame:
    return rows.select("queue", F.from_json("value", VALUE_SCHEMA).alias("v")).select("queue", "v.*")


def once_each(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Drop events redelivered within ``delay`` of their first delivery.

    The clock is the time of arrival (that of the batch), so an event is never
    late: every first delivery passes, however old the event is.
    """
    return (
        events.withColumn("_at", F.current_timestamp())
        .withWatermark("_at", delay)
        .dropDuplicatesWithinWatermark(["id"])
        .drop("_at")
    )


def counts_per_second(events: DataFrame) -> DataFrame:
    """Merged messages per second and type."""
    return (
        filters.merged_messages(events)
        .select(
            clock.to_timestamp(F.col("timestamp")).alias("second"),
            F.col("merge_message_body.message.data.type").alias("message_type"),
        )
        .groupBy("second", "message_type")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def deliver_counts(
    events: DataFrame, target: str, position: str, every_ms: int | None = None
) -> StreamingQuery:
    """Counts per second of each batch below ``target``; ``read_counts`` adds them up.

    No state and no watermark: late events count like all others and the newest
    second is there at once. A repeated batch replaces its own folder.
    """

    def write(batch: DataFrame, number: int) -> None:
        counts_per_second(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", position)
    return _trigger(writer, every_ms).start()


def read_counts(spark: SparkSession, target: str) -> DataFrame:
    schema = "second timestamp, message_type string, n bigint"
    parts = spark.read.schema(schema).parquet(f"{target}/batch=*")
    return parts.groupBy("second", "message_type").agg(F.sum("n").alias("n"))


def watched(rows: DataFrame, name: str = "delivery") -> DataFrame:
    """Attach running statistics: read them from ``query.lastProgress``."""
    return rows.observe(
        name,
        F.count(F.lit(1)).alias("items"),
        F.coalesce(F.max("event_id"), F.lit(0)).alias("last_event_id"),
    )


def _trigger(writer, every_ms: int | None):
    """Every ``every_ms`` milliseconds, or once over all that is there."""
    if every_ms is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{every_ms} milliseconds")


def deliver(
    rows: DataFrame, folder: str, checkpoint: str, every_ms: int | None = BATCH_MILLIS
) -> StreamingQuery:
    """Routed queue sink: one folder per queue, each row exactly once.

    Spark's file sink logs the files of every committed batch, so a batch run
    again after a failure is not seen twice by readers.
    """
    writer = (
        watched(rows)
        .writeStream.format("parquet")
        .partitionBy("queue")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return _trigger(writer, every_ms).start()


def write_batch(rows: DataFrame, batch_id: int, folder: str) -> None:
    """One micro-batch to ``batch_id=<id>``; running it again replaces it.

    The highest delivered id is written after the rows it stands for.
    """
    path = f"{folder}/queues/batch_id={batch_id}"
    rows.write.mode("overwrite").partitionBy("queue").parquet(path)
    spark = rows.sparkSession
    (
        spark.read.schema("event_id bigint, value string, queue string")
        .parquet(path)
        .agg(F.max("event_id").alias("event_id"), F.count(F.lit(1)).alias("items"))
        .coalesce(1)
        .write.mode("overwrite")
        .parquet(f"{folder}/positions/batch_id={batch_id}")
    )


def deliver_batches(
    rows: DataFrame,
    folder: str,
    checkpoint: str,
    every_ms: int | None = BATCH_MILLIS,
    consumer: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Hand each micro-batch to ``consumer``, or to ``write_batch``.

    For sinks outside Spark; the consumer must allow a batch to come twice.
    """
    consume = consumer or (lambda batch, batch_id: write_batch(batch, batch_id, folder))
    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(consume)
    return _trigger(writer, every_ms).start()


def read_queues(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("event_id bigint, value string, queue string").parquet(folder)


def last_position(spark: SparkSession, folder: str) -> int | None:
    """Highest delivered event id."""
    return read_queues(spark, folder).agg(F.max("event_id")).first()[0]


def queue_lengths(rows: DataFrame) -> DataFrame:
    return rows.groupBy("queue").agg(F.count(F.lit(1)).alias("items"))


def peek(rows: DataFrame, queue: str, n: int = 5) -> DataFrame:
    """First ``n`` items of a queue, parsed; nothing is removed."""
    first = rows.filter(F.col("queue") == queue).orderBy("event_id").limit(n)
    items = from_queue_rows(first)
    latency = filters.latency_ms()
    return items.select(
        "event_id",
        "fid",
        "hash",
        "message_type",
        "timestamp",
        latency.alias("latency_ms"),
        labels.latency_band(latency).alias("latency_band"),
        labels.preview(F.col("text")).alias("text"),
        "parent_hash",
        "parent_url",
        F.coalesce(F.size("embeds"), F.lit(0)).alias("embeds"),
        F.array_join("mentions", ",").alias("mentions"),
        "target_hash",
    )


def peek_details(rows: DataFrame, queue: str, now_ms: int, n: int = 5, embeds: int = 3) -> DataFrame:
    """Size, time in the queue and what embeds point to, of the first ``n`` items; nothing is removed."""
    first = rows.filter(F.col("queue") == queue).orderBy("event_id").limit(n)
    item = F.from_json("value", VALUE_SCHEMA)
    told = first.select(F.octet_length("value").alias("bytes"), item.alias("v")).select("bytes", "v.*")
    waited = F.lit(now_ms).cast("long") - F.col("processed_at")
    target = F.transform(
        F.slice(F.coalesce("embeds", F.array().cast(_EMBEDS)), 1, embeds),
        lambda e: F.coalesce(
            F.concat(F.lit("URL: "), e["url"]),
            F.concat(F.lit("Cast: fid="), e["cast_id"]["fid"], F.lit(", hash="), e["cast_id"]["hash"]),
        ),
    )
    return told.select(
        "event_id",
        "bytes",
        waited.alias("waited_ms"),
        F.when(waited < 1000, F.format_string("%dms", waited))
        .when(waited < 60_000, F.concat((waited / 1000).cast("decimal(20,1)"), F.lit("s")))
        .otherwise(F.concat((waited / 60_000).cast("decimal(20,1)"), F.lit("m")))
        .alias("waited"),
        F.array_join(target, "; ").alias("embed_targets"),
    )


_EMBEDS = "array<struct<url: string, cast_id: struct<fid: bigint, hash: string>>>"


class Statistics(StreamingQueryListener):
    """Tells what a watched stream received and delivered, at most every ``every`` seconds.

    Counts come with each batch's progress: rows read, and the rows and highest id that
    ``watched`` observed. ``tell`` gets one line; ``totals`` holds the sums.
    """

    def __init__(self, tell: Callable[[str], None] = print, every: float = 5.0, name: str = "delivery"):
        self.tell, self.every, self.name = tell, every, name
        self.totals = {"batches": 0, "received": 0, "kept": 0, "last_event_id": 0}
        self.finished = threading.Event()  # set when a query has ended and all is counted
        self._told = 0.0

    def onQueryStarted(self, event) -> None:
        self._told = time.monotonic()

    def onQueryProgress(self, event) -> None:
        progress, totals = event.progress, self.totals
        if not progress.numInputRows:
            return
        totals["batches"] += 1
        totals["received"] += progress.numInputRows
        seen = progress.observedMetrics.get(self.name)
        if seen is not None:
            totals["kept"] += seen["items"]
            totals["last_event_id"] = max(totals["last_event_id"], seen["last_event_id"])
        if time.monotonic() - self._told >= self.every:
            self._tell()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._tell()
        self.finished.set()

    def _tell(self) -> None:
        self._told = time.monotonic()
        t = self.totals
        share = 100 * t["kept"] / t["received"] if t["received"] else 0.0
        self.tell(
            f"received {t['received']}, kept {t['kept']} ({share:.2f}%), "
            f"batches {t['batches']}, last event {t['last_event_id']}"
        )
