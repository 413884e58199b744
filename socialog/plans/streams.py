"""Streaming queries: each writes the events below the shared folder and streams them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from socialog.plans import fixtures as fx
from socialog.plans.catalog import query
from socialog.plans.tables import NORMALIZED, normalized_texts
from socialog.session import new_path
from socialog.sources import schemas
from socialog.streaming import delivery, rolled


FILE_ROWS = 500_000  # of a file that is written for a stream, about


def file_count(rows: DataFrame, least: int) -> int:
    """Files of bounded size that ``rows`` fill: a multiple of ``least``."""
    return least * max(1, -(-rows.count() // (FILE_ROWS * least)))


def event_files(spark, sf, files: int = 10) -> str:
    """The events as ``files`` Parquet files in id order."""
    folder = new_path(spark, "events")
    fx.events(spark, sf).repartitionByRange(files, "id").write.parquet(folder)
    return folder


def shuffled_files(spark, sf, files: int = 4, times: int = 1) -> str:
    """The events as Parquet files that each hold events of all times; ``files`` of them or, of many events, a multiple."""
    folder = new_path(spark, "events")
    events = fx.events(spark, sf)
    many = file_count(events, files)
    for _ in range(times):
        events.repartition(many, F.xxhash64("id")).write.mode("append").parquet(folder)
    return folder


def quarter(spark, sf) -> int:
    """How many of the files that ``shuffled_files`` writes at a time make a quarter of them."""
    return file_count(fx.events(spark, sf), 4) // 4


def _run(rows, spark, sink: str) -> None:
    """Stream ``rows`` over all files there are into ``sink``."""
    (
        rows.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", new_path(spark, "position"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _delivered(spark, sf, **options):
    """Run source, filters, JSON and routed sink over all files, then read the sink."""
    source, sink = event_files(spark, sf), new_path(spark, "queues")
    events = delivery.file_events(spark, source, max_files=4)
    rows = delivery.to_queue_rows(delivery.normalized(events, **options))
    delivery.deliver(rows, sink, new_path(spark, "position"), every_ms=None).awaitTermination()
    return delivery.read_queues(spark, sink)


_DELIVERED = f"SELECT queue, {NORMALIZED} FROM delivered"


@query("stream_delivery", _DELIVERED, ("delivered",))
def _(spark, sf):
    parsed = delivery.from_queue_rows(_delivered(spark, sf))
    return normalized_texts(parsed)


@query(
    "stream_delivery_allowed_fids",
    f"{_DELIVERED} WHERE fid IN {fx.ALLOWED_FIDS}",
    ("delivered",),
)
def _(spark, sf):
    parsed = delivery.from_queue_rows(_delivered(spark, sf, fids=fx.ALLOWED_FIDS))
    return normalized_texts(parsed)


@query("batch_delivery", _DELIVERED, ("delivered",))
def _(spark, sf):
    """The same transforms without a stream."""
    casts = delivery.normalized(fx.events(spark, sf))
    return normalized_texts(delivery.from_queue_rows(delivery.to_queue_rows(casts)))


@query(
    "all_types_as_removes",
    f"""SELECT queue, {NORMALIZED} FROM normalized WHERE latency_ms <= 60000""",
    ("normalized",),
)
def _(spark, sf):
    kinds = ("CastAdd", "CastRemove", "LinkAdd")
    return normalized_texts(delivery.normalized(fx.events(spark, sf), kinds))


@query(
    "delivery_latency",
    """SELECT event_id, latency_ms, latency_ms AS cast_latency_ms, latency_band FROM delivered""",
    ("delivered",),
)
def _(spark, sf):
    return delivery.normalized(fx.events(spark, sf)).select(
        "event_id", "latency_ms", "cast_latency_ms", "latency_band"
    )


@query(
    "queue_lengths",
    "SELECT queue, count(*) AS items FROM delivered GROUP BY queue",
    ("delivered",),
)
def _(spark, sf):
    return delivery.queue_lengths(_delivered(spark, sf))


@query(
    "queue_peek",
    """SELECT event_id, fid, hash, message_type, timestamp, latency_ms, latency_band, text,
              parent_hash, parent_url, CASE WHEN embed_urls IS NULL THEN 0 ELSE 1 END AS embeds,
              mentions, target_hash
       FROM delivered WHERE queue = 'casts_add' ORDER BY event_id LIMIT 5""",
    ("delivered",),
)
def _(spark, sf):
    casts = delivery.normalized(fx.events(spark, sf))
    return delivery.peek(delivery.to_queue_rows(casts), delivery.ADD_QUEUE, 5)


@query(
    "stream_position",
    "SELECT max(event_id) AS last_event_id, count(*) AS items FROM delivered",
    ("delivered",),
)
def _(spark, sf):
    return _delivered(spark, sf).agg(
        F.max("event_id").alias("last_event_id"), F.count(F.lit(1)).alias("items")
    )


@query(
    "stream_from_newest",
    f"""SELECT queue, {NORMALIZED} FROM delivered
        WHERE event_id > (SELECT max(id) // 2 FROM stream_events)""",
    ("delivered",),
)
def _(spark, sf):
    """Start where the first half of the events ended."""
    source, sink = event_files(spark, sf), new_path(spark, "queues")
    stored = spark.read.schema(schemas.EVENT).parquet(source)
    half = delivery.newest_id(stored) // 2
    begin = delivery.start_id(stored.filter(F.col("id") <= half))
    events = delivery.file_events(spark, source, start_id=begin, types=["MERGE_MESSAGE"])
    rows = delivery.to_queue_rows(delivery.normalized(events))
    delivery.deliver(rows, sink, new_path(spark, "position"), every_ms=None).awaitTermination()
    parsed = delivery.from_queue_rows(delivery.read_queues(spark, sink))
    return normalized_texts(parsed)


@query(
    "events_per_second",
    """SELECT timestamp + 1609459200 AS second, message_kind AS message_type, count(*) AS n
       FROM stream_events WHERE message_kind IS NOT NULL GROUP BY 1, 2""",
    ("stream_events",),
)
def _(spark, sf):
    return delivery.counts_per_second(fx.events(spark, sf)).withColumn(
        "second", F.unix_seconds("second")
    )


@query(
    "stream_events_per_second",
    """SELECT timestamp + 1609459200 AS second, message_kind AS message_type, count(*) AS n
       FROM stream_events WHERE message_kind IS NOT NULL GROUP BY 1, 2""",
    ("stream_events",),
)
def _(spark, sf):
    """The same counts from batches of shuffled files, in which most events are late."""
    source, sink = shuffled_files(spark, sf), new_path(spark, "seconds")
    events = delivery.file_events(spark, source, max_files=quarter(spark, sf))
    delivery.deliver_counts(events, sink, new_path(spark, "position")).awaitTermination()
    return delivery.read_counts(spark, sink).withColumn("second", F.unix_seconds("second"))


@query(
    "stream_once_each",
    "SELECT id, type, timestamp FROM stream_events",
    ("stream_events",),
)
def _(spark, sf):
    """Shuffled files, a quarter a batch, each delivered twice; each event passes once."""
    source, sink = shuffled_files(spark, sf, times=2), new_path(spark, "once")
    events = delivery.once_each(delivery.file_events(spark, source, max_files=quarter(spark, sf)))
    _run(events.select("id", "type", "timestamp"), spark, sink)
    return spark.read.schema("id bigint, type string, timestamp bigint").parquet(sink)


@query(
    "queue_peek_details",
    """SELECT event_id, octet_length(encode(
                  '{"fid":' || fid || ',"hash":"' || hash || '","timestamp":' || timestamp || ',"text":"' || text || '"'
                  || CASE WHEN embed_urls IS NULL THEN '' ELSE ',"embeds":[{"url":"' || embed_urls || '"}]' END
                  || CASE WHEN mentions IS NULL THEN '' ELSE ',"mentions":[' || mentions || ']' END
                  || CASE WHEN parent_hash IS NULL THEN '' ELSE ',"parent_hash":"' || parent_hash || '"' END
                  || ',"event_id":' || event_id || ',"message_type":"' || message_type || '"'
                  || ',"processed_at":' || processed_at || '}')) AS bytes,
              now - processed_at AS waited_ms,
              CASE WHEN now - processed_at < 1000 THEN (now - processed_at) || 'ms'
                   WHEN now - processed_at < 60000
                       THEN CAST(CAST((now - processed_at) / 1000 AS DECIMAL(20, 1)) AS VARCHAR) || 's'
                   ELSE CAST(CAST((now - processed_at) / 60000 AS DECIMAL(20, 1)) AS VARCHAR) || 'm' END AS waited,
              coalesce('URL: ' || embed_urls, '') AS embed_targets
       FROM (SELECT *, (SELECT max(processed_at) FROM delivered) AS now FROM delivered)
       WHERE queue = 'casts_add' ORDER BY event_id LIMIT 50""",
    ("delivered",),
)
def _(spark, sf):
    casts = delivery.normalized(fx.events(spark, sf))
    now = casts.agg(F.max("processed_at")).first()[0]
    return delivery.peek_details(delivery.to_queue_rows(casts), delivery.ADD_QUEUE, now, 50)


@query(
    "stream_rolled_queues",
    f"SELECT queue, {NORMALIZED} FROM delivered",
    ("delivered",),
)
def _(spark, sf):
    """Small timed batches into files that are rolled by size."""
    source, sink = event_files(spark, sf), new_path(spark, "rolled")
    events = delivery.file_events(spark, source, max_files=2)
    rows = delivery.to_queue_rows(delivery.normalized(events))
    many = fx.events(spark, sf).count()
    run = rolled.deliver(rows, sink, new_path(spark, "position"), every_ms=100, roll_rows=many // 4)
    try:
        run.processAllAvailable()
    finally:
        run.stop()
    return normalized_texts(delivery.from_queue_rows(rolled.read(spark, sink)))


@query(
    "stream_to_consumer",
    "SELECT queue, count(*) AS items, max(event_id) AS last_event_id FROM delivered GROUP BY queue",
    ("delivered",),
)
def _(spark, sf):
    """A consumer of our own gets each micro-batch and adds up what it holds."""
    source, sink = event_files(spark, sf), new_path(spark, "consumed")

    def consume(batch, number):
        held = batch.groupBy("queue").agg(F.count(F.lit(1)).alias("items"), F.max("event_id").alias("last_event_id"))
        held.write.mode("overwrite").parquet(f"{sink}/batch={number}")

    rows = delivery.to_queue_rows(delivery.normalized(delivery.file_events(spark, source, max_files=3)))
    run = delivery.deliver_batches(rows, sink, new_path(spark, "position"), every_ms=None, consumer=consume)
    run.awaitTermination()
    held = spark.read.schema("queue string, items bigint, last_event_id bigint").parquet(f"{sink}/batch=*")
    return held.groupBy("queue").agg(F.sum("items").alias("items"), F.max("last_event_id").alias("last_event_id"))


@query(
    "stream_statistics",
    """SELECT (SELECT count(*) FROM stream_events) AS received, count(*) AS kept, max(event_id) AS last_event_id
       FROM delivered""",
    ("delivered",),
)
def _(spark, sf):
    """What a listener added up while files were delivered a few at a time."""
    source = event_files(spark, sf)
    rows = delivery.to_queue_rows(delivery.normalized(delivery.file_events(spark, source, max_files=3)))
    statistics = delivery.Statistics(tell=lambda line: None)
    spark.streams.addListener(statistics)
    try:
        run = delivery.deliver(rows, new_path(spark, "queues"), new_path(spark, "position"), every_ms=None)
        run.awaitTermination()
        statistics.finished.wait(30)
    finally:
        spark.streams.removeListener(statistics)
    told = [tuple(statistics.totals[k] for k in ("received", "kept", "last_event_id"))]
    return spark.createDataFrame(told, "received bigint, kept bigint, last_event_id bigint")
