"""Interval sets and the redelivery guard on them."""

import numpy as np
from conftest import DATA
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from socialog.plans import fixtures as fx
from socialog.plans import streams
from socialog.plans.catalog import catalog
from socialog.plans.streams import shuffled_files
from socialog.streaming import delivery, guard


@given(st.lists(st.sets(st.integers(0, 60), min_size=1), max_size=6))
def test_intervals_hold_what_was_added(batches):
    starts, ends = np.zeros(0, np.int64), np.zeros(0, np.int64)
    held = set()
    for batch in batches:
        ids = np.array(sorted(batch), np.int64)
        known = guard.covered(ids, starts, ends)
        assert set(ids[known].tolist()) == batch & held
        starts, ends = guard.joined(ids[~known], starts, ends)
        held |= batch
    covered = {i for a, b in zip(starts.tolist(), ends.tolist(), strict=True) for i in range(a, b + 1)}
    assert covered == held
    assert all(b + 1 < a for a, b in zip(starts[1:].tolist(), ends[:-1].tolist(), strict=True))


def run(spark, events, sink, position, **options):
    with guard.state_store(spark):
        query = (
            guard.once_ever(events, **options)
            .writeStream.format("parquet")
            .option("path", sink)
            .option("checkpointLocation", position)
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()


def test_redelivery_of_whole_events_is_caught_after_a_restart(spark, tmp_path):
    sink, position = str(tmp_path / "sink"), str(tmp_path / "position")
    source = shuffled_files(spark, DATA, files=2)
    events = fx.events(spark, DATA)
    for _ in range(2):
        stream = delivery.file_events(spark, source, max_files=1)
        run(spark, stream, sink, position, cut_bits=8)
        events.repartition(2, "shard_index").write.mode("append").parquet(source)
        events.limit(3).selectExpr("CAST(NULL AS BIGINT) AS id", *events.columns[1:]).write.mode("append").parquet(source)
    out = spark.read.parquet(sink).filter("id IS NOT NULL").select(events.columns)
    assert out.exceptAll(events).count() == events.exceptAll(out).count() == 0
    assert spark.read.parquet(sink).filter("id IS NULL").count() == 3
    # A cut that is whole is one interval, whatever came in which order.
    cuts = guard.state_rows(spark, position).collect()
    assert sorted((r["_cut"], r["starts"], r["ends"]) for r in cuts) == [
        (k, [256 * k], [min(256 * k + 255, 999)]) for k in range(4)
    ]


def test_ids_counted_by_shard(spark, tmp_path):
    sink, position, source = (str(tmp_path / x) for x in ("sink", "position", "in"))
    rows = [(i, s) for i in range(40) for s in range(3)] * 2
    spark.createDataFrame(rows, "id long, shard_index long").write.parquet(source)
    stream = spark.readStream.schema("id long, shard_index long").parquet(source)
    run(spark, stream, sink, position, by=["shard_index"])
    assert sorted(map(tuple, spark.read.parquet(sink).collect())) == sorted(set(rows))
    assert [tuple(r) for r in guard.state_rows(spark, position).orderBy("_shard_index").collect()] == [
        (s, 0, [0], [39]) for s in range(3)
    ]


def test_files_of_a_stream_grow_in_number_not_in_rows(spark, monkeypatch):
    monkeypatch.setattr(streams, "FILE_ROWS", 100)
    stored = spark.read.parquet(shuffled_files(spark, DATA))
    by_file = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert sum(by_file) == 1000 and len(by_file) == 12 and max(by_file) < 130
    found = catalog()["stream_once_ever"].build(spark, DATA)
    wanted = fx.events(spark, DATA).select("id", "type", "timestamp")
    assert found.exceptAll(wanted).count() == wanted.exceptAll(found).count() == 0
