from conftest import final_plan
from helpers import flat
from pyspark.sql import functions as F

from socialog.functions.clock import EPOCH
from socialog.operators import filters
from socialog.sources import tables

NOW = 1_705_968_000


def at(spark, *unix):
    return flat(spark, "links", [{"Timestamp": u - EPOCH, "Fid": i} for i, u in enumerate(unix)])


def fids(df):
    return sorted(r["Fid"] for r in df.collect())


def test_future_bound_is_inclusive(spark):
    log = at(spark, NOW + 86_400, NOW + 86_401)
    assert fids(filters.not_future(log, NOW)) == [0]


def test_cutoff_is_inclusive(spark):
    log = at(spark, NOW - 3 * 86_400, NOW - 3 * 86_400 - 1)
    assert fids(filters.last_days(log, 3, NOW)) == [0]


def test_age_bound_is_inclusive(spark):
    ages = [60_000, 60_001, -5]
    events = spark.createDataFrame(
        [(i, 10, (10 + EPOCH) * 1000 + age) for i, age in enumerate(ages)],
        "id bigint, timestamp bigint, processed_at bigint",
    )
    assert sorted(r["id"] for r in filters.fresh(events).collect()) == [0, 2]


def test_empty_allow_list_keeps_everything(spark):
    log = at(spark, NOW, NOW)
    assert fids(filters.of_fids(log, [])) == [0, 1]
    assert fids(filters.of_fids(log, spark.createDataFrame([], "f bigint"))) == [0, 1]


def test_allow_lists_long_and_short_agree(spark):
    log = at(spark, *[NOW] * 30)
    short, long = range(0, 30, 7), [*range(0, 30, 7), *range(100, 12_000)]
    assert fids(filters.of_fids(log, short)) == fids(filters.of_fids(log, long)) == [0, 7, 14, 21, 28]


def test_completeness(spark):
    rows = spark.createDataFrame(
        [((1,), b"\x01"), ((1,), b""), ((1,), None), (None, b"\x01")],
        "data struct<fid: bigint>, hash binary",
    )
    assert tuple(filters.completeness(rows).first()) == (4, 1, 3)
    assert filters.complete(rows).count() == 1


def test_bounds_reach_the_scan(spark, tmp_path):
    at(spark, NOW, NOW).write.parquet(str(tmp_path / "log"))
    log = tables.scan_log(spark, str(tmp_path / "log"), "links")
    plan = final_plan(filters.of_fid(filters.last_days(log, 1, NOW), 1).select("Hash"))
    assert "GreaterThanOrEqual(Timestamp," in plan and "EqualTo(Fid,1)" in plan
    assert "ReadSchema: struct<Fid:bigint,Timestamp:bigint,Hash:string>" in plan


def test_text_match_is_ordered(spark):
    log = flat(spark, "casts", [{"Hash": h, "Embeds": "x url y"} for h in "cab"])
    rows = filters.text_match(log, "Embeds", "%url%", ["Hash"], 2).collect()
    assert [r["Hash"] for r in rows] == ["a", "b"]


def test_time_counts_add_up(spark):
    log = at(spark, NOW - 10 * 86_400, NOW, NOW + 2 * 86_400, NOW + 5)
    row = filters.time_filter_counts(log, NOW, 3).first()
    assert tuple(row) == (4, 1, 1, 2)
    assert log.filter(F.col("Fid") >= 0).count() == row["retrieved"]
