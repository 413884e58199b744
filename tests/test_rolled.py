"""Rolled queue files, consumers, listener statistics, item details."""

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from socialog.plans import fixtures as fx
from socialog.streaming import delivery, rolled


@pytest.fixture(scope="module")
def rows(spark):
    return delivery.to_queue_rows(delivery.normalized(fx.events(spark, DATA))).cache()


def batch(rows, k, of=6):
    return rows.filter(F.col("event_id") % of == k)


def pairs(df):
    return sorted(tuple(r) for r in df.select("queue", "event_id", "value").collect())


def files(spark, folder):
    return rolled.read(spark, folder).inputFiles()


def test_files_are_rolled_by_size(spark, rows, tmp_path):
    folder, many = str(tmp_path), rows.count()
    for k in range(6):
        rolled.write_batch(batch(rows, k), k, folder, roll_rows=many // 3)
    assert pairs(rolled.read(spark, folder)) == pairs(rows)
    assert rolled.position(spark, folder) == rows.agg(F.max("event_id")).first()[0]
    rolls, behind = rolled._in_use(spark, folder)
    assert rolls and len(behind) < 4
    assert all("/rolled/" in f for f in files(spark, folder)) or behind
    assert rolled.drop_rolled(spark, folder) == 6 - len(behind)
    assert rolled.drop_rolled(spark, folder) == 0
    assert pairs(rolled.read(spark, folder)) == pairs(rows)


def test_a_batch_run_twice_is_seen_once(spark, rows, tmp_path):
    for k in (0, 0, 1, 0, 1):
        rolled.write_batch(batch(rows, k, 2), k, str(tmp_path))
    assert pairs(rolled.read(spark, str(tmp_path))) == pairs(rows)


@pytest.mark.parametrize("lost", ["_commit", "roll"])
def test_what_is_not_committed_is_not_seen(spark, rows, tmp_path, monkeypatch, lost):
    folder = str(tmp_path)

    class Lost(Exception):
        pass

    def stop(*_):
        raise Lost

    rolled.write_batch(batch(rows, 0, 2), 0, folder)
    with monkeypatch.context() as patch:
        patch.setattr(rolled, lost, stop)
        with pytest.raises(Lost):
            rolled.write_batch(batch(rows, 1, 2), 1, folder, roll_rows=1)
    seen = rows if lost == "roll" else batch(rows, 0, 2)
    assert pairs(rolled.read(spark, folder)) == pairs(seen)
    rolled.write_batch(batch(rows, 1, 2), 1, folder, roll_rows=1)
    assert pairs(rolled.read(spark, folder)) == pairs(rows)


def test_empty_batches_and_an_empty_sink(spark, rows, tmp_path):
    folder = str(tmp_path)
    assert rolled.read(spark, folder).count() == 0 and rolled.position(spark, folder) is None
    rolled.roll(spark, folder)
    rolled.write_batch(rows.limit(0), 0, folder, roll_rows=1)
    rolled.write_batch(batch(rows, 1), 1, folder, roll_rows=1)
    assert pairs(rolled.read(spark, folder)) == pairs(batch(rows, 1))


def test_listener_adds_up_and_tells(spark, tmp_path):
    source, lines = str(tmp_path / "in"), []
    fx.events(spark, DATA).repartition(4).write.parquet(source)
    statistics = delivery.Statistics(tell=lines.append, every=0)
    spark.streams.addListener(statistics)
    try:
        queue_rows = delivery.to_queue_rows(delivery.normalized(delivery.file_events(spark, source, max_files=2)))
        delivery.deliver(queue_rows, str(tmp_path / "q"), str(tmp_path / "p"), None).awaitTermination()
        assert statistics.finished.wait(30)
    finally:
        spark.streams.removeListener(statistics)
    kept = delivery.read_queues(spark, str(tmp_path / "q")).count()
    assert statistics.totals["batches"] == 2 and statistics.totals["kept"] == kept
    assert lines[-1].startswith(f"received {fx.events(spark, DATA).count()}, kept {kept} (")
    assert len(lines) == 3


def test_default_consumer_and_own_consumer(spark, rows, tmp_path):
    source, seen = str(tmp_path / "in"), []
    fx.events(spark, DATA).repartition(4).write.parquet(source)
    stream = delivery.to_queue_rows(delivery.normalized(delivery.file_events(spark, source, max_files=2)))
    folder = str(tmp_path / "out")
    delivery.deliver_batches(stream, folder, str(tmp_path / "p"), None).awaitTermination()
    assert pairs(delivery.read_queues(spark, f"{folder}/queues")) == pairs(rows)
    consume = lambda batch, number: seen.append((number, batch.count()))
    delivery.deliver_batches(stream, folder, str(tmp_path / "p2"), None, consume).awaitTermination()
    assert [n for n, _ in seen] == [0, 1] and sum(n for _, n in seen) == rows.count()


def test_details_of_items(spark):
    def item(event_id, at, embeds):
        return spark.range(1).select(
            F.lit("q").alias("queue"), F.lit(event_id).cast("long").alias("event_id"),
            F.to_json(F.struct(F.lit(event_id).alias("event_id"), F.lit(at).alias("processed_at"), embeds.alias("embeds"))).alias("value"),
        )

    url = lambda u: F.struct(F.lit(u).alias("url"), F.lit(None).cast("struct<fid: bigint, hash: string>").alias("cast_id"))
    cast = F.struct(
        F.lit(None).cast("string").alias("url"),
        F.struct(F.lit(3).cast("bigint").alias("fid"), F.lit("ab").alias("hash")).alias("cast_id"),
    )
    none = F.lit(None).cast(delivery._EMBEDS)
    queue = item(1, 99_500, none).union(item(2, 88_000, F.array(url("u"), cast, url("v"), url("w")))).union(item(3, 10_000, none))
    found = [tuple(r) for r in delivery.peek_details(queue, "q", 100_000, 3).drop("bytes").collect()]
    assert found == [(1, 500, "500ms", ""), (2, 12_000, "12.0s", "URL: u; Cast: fid=3, hash=ab; URL: v"), (3, 90_000, "1.5m", "")]
