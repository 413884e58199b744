"""Event pages, the guard without a time limit, and state kept up from a stream."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from socialog.plans import fixtures as fx
from socialog.plans.catalog import query
from socialog.plans.state import LIVE_SQL
from socialog.plans.streams import file_count, quarter, shuffled_files
from socialog.session import new_path
from socialog.sources import pages, schemas
from socialog.streaming import delivery, guard, upkeep

_NARROW = ("id", "type", "timestamp", "shard_index")


def _paged(spark, sf) -> str:
    """The events as pages of about an eighth of a shard, stored in two appends."""
    events, folder = fx.events(spark, sf), new_path(spark, "event-pages")
    many, half = events.agg(F.count(F.lit(1)), F.expr("max(id) div 2")).first()
    for part in (events.filter(F.col("id") <= half), events.filter(F.col("id") > half)):
        pages.append_pages(part, folder, max(1, many // 24))
    return folder


@query(
    "event_pages_reverse",
    """SELECT id, type, timestamp, shard_index FROM stream_events
       WHERE shard_index = 1 AND type = 'MERGE_MESSAGE'
         AND id > (SELECT max(id) // 3 FROM stream_events) AND id <= (SELECT max(id) * 2 // 3 FROM stream_events)""",
    ("stream_events",),
)
def _(spark, sf):
    last = fx.events(spark, sf).agg(F.max("id")).first()[0]
    return pages.read_pages(
        spark, _paged(spark, sf), _NARROW, from_id=last // 3, stop_id=last * 2 // 3,
        types=["MERGE_MESSAGE"], shard=1, reverse=True,
    )


@query(
    "event_pages_stream",
    """SELECT id, type, timestamp, shard_index FROM stream_events
       WHERE type = 'MERGE_MESSAGE' AND id > (SELECT max(id) // 3 FROM stream_events)""",
    ("stream_events",),
)
def _(spark, sf):
    """From the middle of a page on, a few pages a batch; stopped in between and started again."""
    folder, sink, position = _paged(spark, sf), new_path(spark, "queues"), new_path(spark, "position")
    many, last = fx.events(spark, sf).agg(F.count(F.lit(1)), F.max("id")).first()
    for to_the_end in (False, True):
        events = pages.stream_pages(
            spark, folder, _NARROW, from_id=last // 3, types=["MERGE_MESSAGE"],
            max_rows=many // 4, position=position,
        )
        run = (
            events.writeStream.format("parquet")
            .option("path", sink)
            .option("checkpointLocation", position)
            .trigger(processingTime="0 seconds")
            .start()
        )
        if to_the_end:
            run.processAllAvailable()
        else:
            while run.isActive and not any(p["numInputRows"] for p in run.recentProgress):
                time.sleep(0.02)
        run.stop()
        if run.exception() is not None:
            raise run.exception()
    return spark.read.schema(events.schema).parquet(sink)


@query("stream_once_ever", "SELECT id, type, timestamp FROM stream_events", ("stream_events",))
def _(spark, sf):
    """Shuffled files, a quarter a batch, all delivered again in a later run, dealt anew; each event passes once."""
    source, sink, position = shuffled_files(spark, sf), new_path(spark, "once"), new_path(spark, "position")
    for _ in range(2):
        events = delivery.file_events(spark, source, max_files=quarter(spark, sf)).select("id", "type", "timestamp")
        with guard.state_store(spark):
            run = (
                guard.once_ever(events)
                .writeStream.format("parquet")
                .option("path", sink)
                .option("checkpointLocation", position)
                .trigger(availableNow=True)
                .start()
            )
        run.awaitTermination()
        again = fx.events(spark, sf)
        again.repartition(file_count(again, 3), "shard_index", "id").write.mode("append").parquet(source)
    return spark.read.schema(events.schema).parquet(sink)


def _kept_up(spark, sf, kind, kept):
    """The log of a kind in shuffled files, a few a batch, each file there twice."""
    source = new_path(spark, f"{kind}-log")
    for _ in range(2):
        rows = fx.FLAT[kind](spark, sf)
        files = file_count(rows, 3)
        rows.repartition(files, F.xxhash64("Hash")).write.mode("append").parquet(source)
    schema = schemas.FLAT[kind]
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files // 3 * 2).parquet(source)
    upkeep.keep_up(stream, kept, new_path(spark, "position")).awaitTermination()
    return upkeep.live(spark, kept, schema)


@query("kept_live_links", LIVE_SQL["links"], ("live_links",))
def _(spark, sf):
    return _kept_up(spark, sf, "links", upkeep.kept_links(new_path(spark, "state"), cuts=8))


@query("kept_live_reactions", LIVE_SQL["reactions"], ("live_reactions",))
def _(spark, sf):
    return _kept_up(spark, sf, "reactions", upkeep.kept_reactions(new_path(spark, "state"), cuts=8))
