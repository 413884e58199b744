import pytest
from conftest import DATA
from pyspark.sql import functions as F

from socialog.operators.graph import reconcile
from socialog.plans import fixtures as fx
from socialog.streaming import delivery


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("events") / "all")
    fx.events(spark, DATA).repartitionByRange(10, "id").write.parquet(folder)
    return folder


def queue_rows(spark, source, **options):
    return delivery.to_queue_rows(
        delivery.normalized(delivery.file_events(spark, source, max_files=3), **options)
    )


def pairs(df):
    return sorted(tuple(r) for r in df.select("queue", "event_id", "value").collect())


def batch_pairs(spark, **options):
    return pairs(delivery.to_queue_rows(delivery.normalized(fx.events(spark, DATA), **options)))


def test_stream_equals_batch_and_resumes(spark, source, tmp_path):
    sink, position = str(tmp_path / "sink"), str(tmp_path / "position")
    first = delivery.deliver(queue_rows(spark, source), sink, position, None)
    first.awaitTermination()
    delivered = pairs(delivery.read_queues(spark, sink))
    assert delivered == batch_pairs(spark)
    again = delivery.deliver(queue_rows(spark, source), sink, position, None)
    again.awaitTermination()
    assert pairs(delivery.read_queues(spark, sink)) == delivered
    assert sum(p["numInputRows"] for p in again.recentProgress) == 0


def test_new_files_are_picked_up_from_the_position(spark, tmp_path):
    folder, sink = str(tmp_path / "in"), str(tmp_path / "out")
    events = fx.events(spark, DATA)
    events.filter("id < 400").write.mode("append").parquet(folder)
    delivery.deliver(queue_rows(spark, folder), sink, str(tmp_path / "p"), None).awaitTermination()
    events.filter("id >= 400").write.mode("append").parquet(folder)
    delivery.deliver(queue_rows(spark, folder), sink, str(tmp_path / "p"), None).awaitTermination()
    assert pairs(delivery.read_queues(spark, sink)) == batch_pairs(spark)


def test_intake_is_bounded_and_watched(spark, source, tmp_path):
    run = delivery.deliver(
        queue_rows(spark, source), str(tmp_path / "s"), str(tmp_path / "p"), None
    )
    run.awaitTermination()
    steps = [p for p in run.recentProgress if p["numInputRows"]]
    assert len(steps) == 4  # ten files, at most three at a time
    items = sum(p["observedMetrics"]["delivery"]["items"] for p in steps)
    last = max(p["observedMetrics"]["delivery"]["last_event_id"] for p in steps)
    assert items == len(batch_pairs(spark))
    assert last == delivery.last_position(spark, str(tmp_path / "s"))


def test_timed_trigger_runs_until_stopped(spark, source, tmp_path):
    run = delivery.deliver(queue_rows(spark, source), str(tmp_path / "s"), str(tmp_path / "p"), 100)
    try:
        run.processAllAvailable()
    finally:
        run.stop()
    assert pairs(delivery.read_queues(spark, str(tmp_path / "s"))) == batch_pairs(spark)


def test_nothing_is_lost_or_doubled(spark, source, tmp_path):
    delivery.deliver(
        queue_rows(spark, source), str(tmp_path / "s"), str(tmp_path / "p"), None
    ).awaitTermination()
    sent = delivery.normalized(fx.events(spark, DATA)).select("event_id")
    got = delivery.read_queues(spark, str(tmp_path / "s")).select("event_id")
    row = reconcile(sent, got, ["event_id"]).first()
    assert (row["missing"], row["unexpected"], row["duplicated"]) == (0, 0, 0)


def test_repeating_a_batch_changes_nothing(spark, tmp_path):
    folder = str(tmp_path / "out")
    rows = delivery.to_queue_rows(delivery.normalized(fx.events(spark, DATA)))
    for batch_id in (0, 0, 1, 1):
        delivery.write_batch(rows.filter(F.col("event_id") % 2 == batch_id), batch_id, folder)
    stored = delivery.read_queues(spark, f"{folder}/queues")
    assert pairs(stored) == batch_pairs(spark)
    positions = spark.read.parquet(f"{folder}/positions")
    assert positions.agg(F.sum("items")).first()[0] == stored.count()
    assert delivery.start_id(fx.events(spark, DATA), positions) == stored.agg(F.max("event_id")).first()[0]


def test_start_without_a_position_is_the_newest_event(spark):
    events = fx.events(spark, DATA)
    none = spark.createDataFrame([], "event_id bigint")
    assert delivery.start_id(events, none) == events.agg(F.max("id")).first()[0]
    assert delivery.newest_id(events.limit(0)) == 0


def test_redelivered_events_pass_once(spark, tmp_path):
    folder, sink = str(tmp_path / "in"), str(tmp_path / "out")
    events = fx.events(spark, DATA).filter("id < 50")
    events.write.mode("append").parquet(folder)
    options = {"path": sink, "checkpointLocation": str(tmp_path / "p")}

    def run():
        rows = delivery.once_each(delivery.file_events(spark, folder, max_files=1)).select("id")
        rows.writeStream.format("parquet").options(**options).trigger(
            availableNow=True
        ).start().awaitTermination()

    run()
    events.write.mode("append").parquet(folder)
    run()
    assert sorted(r["id"] for r in spark.read.parquet(sink).collect()) == list(range(50))


def test_other_types_are_labelled_removes(spark):
    events = fx.events(spark, DATA)
    rows = delivery.normalized(events, ["LinkAdd"], max_age_ms=10**9)
    labels = rows.select("message_type", "queue", "text", "target_hash").distinct().collect()
    assert [tuple(r) for r in labels] == [("cast_remove", delivery.REMOVE_QUEUE, None, None)]


def test_json_leaves_nulls_out(spark):
    value = delivery.to_queue_rows(delivery.normalized(fx.events(spark, DATA))).filter(
        F.col("queue") == delivery.REMOVE_QUEUE
    ).first()["value"]
    assert "null" not in value and '"text"' not in value and '"target_hash"' in value


def test_peek_reads_in_id_order(spark):
    rows = delivery.to_queue_rows(delivery.normalized(fx.events(spark, DATA)))
    first = [r["event_id"] for r in delivery.peek(rows, delivery.ADD_QUEUE, 4).collect()]
    want = [e for q, e, _ in batch_pairs(spark) if q == delivery.ADD_QUEUE][:4]
    assert first == want
