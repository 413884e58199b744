"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from socialog.operators import normalize
from socialog.plans import fixtures as fx
from socialog.plans.catalog import catalog
from socialog.session import local_session, new_path
from socialog.sources import sinks
from socialog.streaming import delivery

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "live_casts",
    "live_reactions",
    "live_reactions_ranked",
    "live_links",
    "profile_wide_max",
    "profile_wide_latest",
    "compact_link_state",
    "replies",
    "user_edges",
    "casts_per_day",
    "reactions_by_month",
    "top_followed",
    "top_reacted_casts",
    "pro_members",
    "address_roles",
    "storage_use",
    "latency_statistics",
    "rolling_p99",
    "recent_throughput",
    "page_numbers",
    "even_parts",
    "flat_casts",
    "batch_delivery",
    "stream_delivery",
)
# Timed beside the total, which stays comparable from round to round.
ALSO = (
    "live_compacted_links",
    "kept_live_links",
    "live_casts_bucketed",
    "replies_bucketed",
    "casts_mentioning_by_postings",
    "lost_and_repeated_events",
    "users_per_day",
    "event_pages_stream",
    "stream_once_ever",
    "stream_rolled_queues",
)
COPIES = 10  # the log is repeated this often for the two throughput figures


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def noop(df) -> None:
    """Run the whole plan and drop the rows on the executors."""
    df.write.format("noop").mode("overwrite").save()


def calibrate(spark) -> float:
    """Seconds of a fixed job on all cores: what this machine is worth right now."""
    hashes = spark.range(0, 400_000_000, 1, 64).select(F.xxhash64("id").alias("h"))
    return min(timed(lambda: noop(hashes.agg(F.max("h")))) for _ in range(3))


def prepare_logs(spark) -> None:
    """Derive and store the log tables that the queries scan, several jobs at a time."""
    logs = (*fx.FLAT.values(), *(fx.MESSAGES[kind] for kind in fx.FLAT), fx.events, fx.calls)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda table: table(spark, SF_DIR), logs))


def normalize_and_write(spark) -> float:
    """Rows per second from nested messages to tuned Parquet."""
    source = new_path(spark, "bench-messages")
    messages = fx.reaction_messages(spark, SF_DIR)
    for _ in range(COPIES):
        messages.write.mode("append").parquet(source)
    stored = spark.read.schema(messages.schema).parquet(source)
    rows = stored.count()
    flat = normalize.flatten_reactions(stored)
    return rows / timed(lambda: sinks.write_tuned(flat, new_path(spark, "bench-flat")))


def stream(spark) -> float:
    """Events per second from the event files to the routed queues."""
    source = new_path(spark, "bench-events")
    for _ in range(COPIES):
        fx.events(spark, SF_DIR).write.mode("append").parquet(source)
    rows = delivery.to_queue_rows(delivery.normalized(delivery.file_events(spark, source)))
    sink, position = new_path(spark, "bench-queues"), new_path(spark, "bench-position")
    count = spark.read.parquet(source).count()
    return count / timed(lambda: delivery.deliver(rows, sink, position, None).awaitTermination())


def main() -> None:
    spark = local_session(CPUS, **{"spark.sql.shuffle.partitions": CPUS})
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog()
    noop(spark.range(10_000_000).groupBy((F.col("id") % 1000).alias("k")).count())  # warm up
    before = calibrate(spark)
    seconds = {"prepare_logs": round(timed(lambda: prepare_logs(spark)), 3)}
    seconds |= {
        name: round(timed(lambda q=queries[name]: noop(q.build(spark, SF_DIR))), 3)
        for name in HEADLINE
    }
    also = {name: round(timed(lambda q=queries[name]: noop(q.build(spark, SF_DIR))), 3) for name in ALSO}
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")),
                "also": also,
                "calibration_sec": [round(before, 3), round(calibrate(spark), 3)],
                "normalize_and_write_rows_per_sec": round(normalize_and_write(spark)),
                "stream_events_per_sec": round(stream(spark)),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
