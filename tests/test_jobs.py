import pytest
from conftest import DATA, final_plan
from pyspark.sql import functions as F

from socialog.functions.clock import EPOCH
from socialog.plans import fixtures as fx
from socialog.plans import jobs
from socialog.sources import tables
from socialog.streaming import delivery

LATER = 1_735_689_600


@pytest.fixture(scope="module")
def messages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("messages") / "all")
    for kind in fx.FLAT:
        fx.messages(spark, DATA, kind).write.mode("append").parquet(folder)
    return folder


@pytest.mark.parametrize("kind", fx.FLAT)
def test_each_kind_is_sorted_out_of_a_mixed_source(spark, messages, tmp_path, kind):
    written = jobs.write_log(spark, messages, str(tmp_path), kind, LATER)
    want = fx.FLAT[kind](spark, DATA)
    got = tables.scan_kind(spark, str(tmp_path), kind)
    assert written == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    target = str(tmp_path / "state")
    jobs.export_state(spark, str(tmp_path), kind, target)
    assert spark.read.parquet(target).count() == jobs.STATE[kind](want).count()


def test_bounds_reach_the_nested_scan(spark, messages):
    kept = jobs.wanted_messages(tables.scan_messages(spark, messages), "links", LATER, fid=3, days=400)
    plan = final_plan(kept.select("data.fid"))
    assert "EqualTo(data.fid,3)" in plan
    assert f"GreaterThanOrEqual(data.timestamp,{LATER - 400 * 86_400 - EPOCH})" in plan
    assert "cast_add_body" not in plan  # bodies are pruned


def test_message_without_time_passes(spark):
    rows = [("LinkAdd", None), ("LinkAdd", 10**9), ("LinkAdd", 5), ("CastAdd", 5)]
    frame = spark.createDataFrame(rows, "type string, timestamp bigint").select(
        F.struct("type", "timestamp").alias("data")
    )
    kept = jobs.wanted_messages(frame, "links", EPOCH).select("data.timestamp").collect()
    assert sorted(str(r[0]) for r in kept) == ["5", "None"]


def test_listener_keeps_recent_events_only(spark, tmp_path):
    """Old test events are dropped by age; one stamped now is delivered."""
    events = fx.events(spark, DATA).filter("merge_message_body is not null").limit(20)
    seconds = F.unix_seconds(F.current_timestamp()) - EPOCH
    fresh = events.withColumn("timestamp", F.when(F.col("id") == F.lit(
        events.agg(F.min("id")).first()[0]), seconds).otherwise(F.col("timestamp")))
    fresh.write.parquet(str(tmp_path / "in"))
    jobs.listen(
        spark, str(tmp_path / "in"), str(tmp_path / "q"), str(tmp_path / "p"),
        types=("CastAdd", "CastRemove", "LinkAdd"), every_ms=None,
    ).awaitTermination()
    rows = delivery.from_queue_rows(delivery.read_queues(spark, str(tmp_path / "q"))).collect()
    assert len(rows) == 1 and rows[0]["processed_at"] > LATER * 1000


def test_pro_members_as_csv(spark, tmp_path):
    target = str(tmp_path / "csv")
    jobs.export_pro_members(fx.tiers(spark, DATA), fx.verifications(spark, DATA), fx.NOW, target)
    lines = [r["value"] for r in spark.read.text(target).collect()]
    assert len(lines) == 30 and all(line.split(",")[0].isdigit() for line in lines)
