"""Event pages: ranges, offsets by id, restarts."""

import json
import time

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from socialog.plans import fixtures as fx
from socialog.sources import pages, schemas

ROWS = 70


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pages"))
    events = fx.events(spark, DATA)
    for part in (events.filter("id < 500"), events.filter("id >= 500"), events.limit(0)):
        pages.append_pages(part, path, ROWS)
    return path


def ids(df):
    return [r["id"] for r in df.select("id").collect()]


def stream(spark, folder, sink, checkpoint, until=None, **options):
    """Run until ``until`` says so of the batches with rows, or to the end; gives those batches."""
    events = pages.stream_pages(spark, folder, ["id", "type", "shard_index"], **options)
    run = (
        events.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime="0 seconds")
        .start()
    )
    give_up = time.time() + 60
    if until is None:
        run.processAllAvailable()
    else:
        while run.isActive and not until(run.recentProgress) and time.time() < give_up:
            time.sleep(0.02)
    run.stop()
    assert run.exception() is None
    return {p["batchId"]: p["numInputRows"] for p in run.recentProgress if p["numInputRows"]}


def test_pages_hold_one_shard_each_and_are_listed(spark, folder):
    listed = pages.listed_pages(spark, folder).collect()
    assert sum(r["rows"] for r in listed) == fx.events(spark, DATA).count()
    assert max(r["rows"] for r in listed) <= ROWS
    for r in listed:
        stored = spark.read.parquet(r["path"]).agg(F.min("id"), F.max("id"), F.min("shard_index"), F.max("shard_index"))
        assert tuple(stored.first()) == (r["first"], r["last"], r["shard"], r["shard"])


def test_whole_read_gives_the_events_back(spark, folder):
    events = fx.events(spark, DATA)
    read = pages.read_pages(spark, folder)
    assert read.schema == schemas.EVENT
    assert read.exceptAll(events).count() == events.exceptAll(read).count() == 0


@pytest.mark.parametrize("reverse", [False, True])
def test_a_range_of_a_shard_comes_in_order(spark, folder, reverse):
    found = ids(pages.read_pages(spark, folder, from_id=100, stop_id=800, shard=1, types=["MERGE_MESSAGE"], reverse=reverse))
    wanted = fx.events(spark, DATA).filter("id > 100 AND id <= 800 AND shard_index = 1 AND type = 'MERGE_MESSAGE'")
    assert found == sorted(ids(wanted), reverse=reverse)


def test_only_pages_in_the_range_are_read(spark, folder):
    listed = [r for r in pages.listed_pages(spark, folder).collect() if r["last"] > 900 and r["shard"] == 2]
    read = pages.read_pages(spark, folder, ["id"], from_id=900, shard=2)
    assert read.rdd.getNumPartitions() == len(listed) < pages.listed_pages(spark, folder).count()
    assert ids(pages.read_pages(spark, folder, ["id"], from_id=10_000)) == []


def test_a_stream_starts_in_a_page_and_restarts_by_id(spark, folder, tmp_path):
    sink, position = str(tmp_path / "sink"), str(tmp_path / "position")
    options = {"from_id": 333, "max_rows": 3 * ROWS, "position": position}
    first = stream(spark, folder, sink, position, until=lambda steps: any(p["numInputRows"] for p in steps), **options)
    rest = stream(spark, folder, sink, position, **options)
    assert max([*first.values(), *rest.values()]) <= 3 * ROWS
    assert len(first) + len(rest) > 2
    found = ids(spark.read.parquet(sink))
    assert len(found) == len(set(found))
    assert sorted(found) == sorted(ids(fx.events(spark, DATA).filter("id > 333")))
    assert pages.last_offset(position) == {
        str(r["shard_index"]): r["last"]
        for r in fx.events(spark, DATA).groupBy("shard_index").agg(F.max("id").alias("last")).collect()
    }
    assert stream(spark, folder, sink, position, **options) == {}


def test_a_batch_that_was_planned_but_not_done_is_done_again(spark, folder, tmp_path):
    sink, position = tmp_path / "sink", tmp_path / "position"
    options = {"max_rows": 3 * ROWS, "position": str(position)}
    stream(spark, folder, str(sink), str(position), until=lambda steps: len(steps) > 1, **options)
    done = sorted(int(p.name) for p in (position / "commits").iterdir() if p.name.isdigit())
    for name in (str(done[-1]), f".{done[-1]}.crc"):  # as if it had stopped before the commit
        (position / "commits" / name).unlink()
        (sink / "_spark_metadata" / name).unlink()
    stream(spark, folder, str(sink), str(position), **options)
    found = ids(spark.read.parquet(str(sink)))
    assert sorted(found) == sorted(ids(fx.events(spark, DATA)))


def test_pages_that_come_later_and_a_stop(spark, tmp_path):
    folder, sink, position = (str(tmp_path / x) for x in ("pages", "sink", "position"))
    events = fx.events(spark, DATA).select("id", "type", F.when(F.col("id") % 9 != 0, F.col("shard_index")).alias("shard_index"))
    pages.append_pages(events.filter("id < 400 AND (shard_index <> 2 OR shard_index IS NULL)"), folder, ROWS)
    stream(spark, folder, sink, position, stop_id=900)
    pages.append_pages(events.filter("id >= 400"), folder, ROWS)
    stream(spark, folder, sink, position, stop_id=900)
    found = ids(spark.read.parquet(sink))
    wanted = events.filter("id >= 400 AND id <= 900 OR id < 400 AND (shard_index <> 2 OR shard_index IS NULL)")
    assert sorted(found) == sorted(ids(wanted))


def test_from_the_newest_on(spark, tmp_path):
    folder, sink, position = (str(tmp_path / x) for x in ("pages", "sink", "position"))
    events = fx.events(spark, DATA).select("id", "type", "shard_index")
    pages.append_pages(events.filter("id < 600"), folder, ROWS)
    assert stream(spark, folder, sink, position, from_id="newest") == {}
    pages.append_pages(events.filter("id >= 600"), folder, ROWS)
    stream(spark, folder, sink, position, from_id="newest")
    assert sorted(ids(spark.read.parquet(sink))) == list(range(600, events.count()))


def test_offsets_of_a_checkpoint(tmp_path):
    assert pages.last_offset(str(tmp_path)) is None
    for kind in ("offsets", "commits"):
        (tmp_path / kind).mkdir()
    (tmp_path / "offsets" / "4").write_text("v1\n{}\n" + json.dumps({"0": 9}))
    (tmp_path / "offsets" / "5").write_text("v1\n{}\n" + json.dumps({"0": 11}))
    (tmp_path / "commits" / "4").write_text("v1\n{}")
    assert pages.last_offset(str(tmp_path)) == {"0": 9}
