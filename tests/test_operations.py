import math
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from socialog.operators import operations as op
from socialog.sources import sinks


pytestmark = pytest.mark.usefixtures("many_tasks")


def p99(values):
    ordered = sorted(values)
    return ordered[math.ceil(len(ordered) * 0.99) - 1]


@pytest.mark.parametrize("window, chunk", [(50, 60), (100, 100), (7, 1000)])
def test_rolling_p99_matches_brute_force(spark, window, chunk):
    rng = random.Random(3)
    rows = [(i, "hot" if i % 3 else rng.choice("ab"), rng.random()) for i in range(900)]
    calls = spark.createDataFrame(rows, "id bigint, context string, ms double").repartition(5)
    found = {
        r["id"]: r["p99"]
        for r in op.rolling_p99(calls, "context", ["id"], "ms", window, chunk).collect()
    }
    seen, want = {}, {}
    for i, context, value in rows:
        past = seen.setdefault(context, [])
        past.append(value)
        want[i] = p99(past[-window:])
    assert found == want


def test_executors_do_not_need_the_package(tmp_path):
    from pyspark import cloudpickle

    (tmp_path / "f").write_bytes(cloudpickle.dumps(op._window_p99(10)))
    code = "import pickle, numpy; print(pickle.load(open('f', 'rb'))(numpy.arange(5.0)))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert "[0. 1. 2. 3. 4.]" in done.stdout, done.stderr


@pytest.mark.parametrize("q", [0.0, 0.01, 0.5, 0.99, 1.0])
def test_percentile_disc_is_exact(spark, q):
    rng = random.Random(11)
    values = [float(rng.choice([1, 1, 1, rng.randrange(5000)])) for _ in range(4001)]
    df = spark.createDataFrame([(v,) for v in values], "ms double").repartition(6)
    rank = max(math.ceil(q * len(values)), 1)
    assert op.percentile_disc(df, "ms", q) == sorted(values)[rank - 1]


def test_percentile_when_the_bracket_misses(spark):
    df = spark.range(500).select((F.col("id") % 50).cast("double").alias("ms"))
    values = df.select(F.col("ms").alias("v"))
    assert op._at_rank(values, 40.0, 10) is None  # among the values below
    assert op._at_rank(values.filter("v < 10"), None, 400) is None
    assert op._at_rank(values, None, 10) == 0.0


def test_percentile_of_nothing(spark):
    assert op.percentile_disc(spark.createDataFrame([], "ms double"), "ms", 0.99) is None


def test_recent_throughput_sees_across_midnight(spark):
    day = 86_400
    at = [day - 61, day - 60, day - 1, day - 1, day, day + 59, day + 60, 3 * day]
    calls = spark.createDataFrame([("c", t) for t in at], "context string, called_at bigint")
    found = {r["called_at"]: r["recent"] for r in op.recent_throughput(calls, "context").collect()}
    assert found == {t: sum(t - 60 <= u <= t for u in at) for t in set(at)}


def test_progress_reports_every_mark(spark):
    per_fid = spark.createDataFrame(
        [(f, f % 3, 100) for f in range(1, 26)], "Fid bigint, messages bigint, elapsed_ms bigint"
    )
    rows = {r["current_fid"]: r for r in op.progress(per_fid, 25, 1, step=10).collect()}
    assert sorted(rows) == [1, 10, 20]
    for mark, row in rows.items():
        done = [f for f in range(1, 26) if f > mark]
        assert row["active_fids"] == sum(f % 3 > 0 for f in done)
        assert row["messages"] == sum(f % 3 for f in done)
        assert row["percent"] == pytest.approx(100 * (25 - mark) / 24)
        assert row["fids_per_second"] == pytest.approx(10)
        assert row["remaining_seconds"] == pytest.approx((mark - 1) / 10)


def test_progress_without_any_message_still_reports(spark):
    none = spark.createDataFrame([], "Fid bigint, messages bigint, elapsed_ms bigint")
    rows = op.progress(none, 3000, 1).orderBy("current_fid").collect()
    assert [(r["current_fid"], r["messages"]) for r in rows] == [(1, 0), (1000, 0), (2000, 0)]
    assert rows[0]["remaining_seconds"] is None


def test_sweep_summary_counts_failures(spark):
    log = spark.createDataFrame([(1,), (1,), (3,), (99,)], "Fid bigint")
    failed = spark.createDataFrame([(2,), (2,)], "Fid bigint")
    row = op.sweep_summary(log, 10, 1, failed).first()
    assert tuple(row) == (10, 2, 3, 1)
    assert op.sweep_summary(log, 10, 1).first()["failed_fids"] == 0


def test_key_rows_leave_out_blank_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("",), (None,), ("b",)], "k string")
    assert dict(op.key_rows(df, "k").collect()) == {"a": 2, "b": 1}


def test_statistics_of_nothing_are_zero(spark):
    calls = spark.createDataFrame(
        [], "context string, ok boolean, error_type string, retries bigint, latency_ms double, called_at bigint"
    )
    assert set(op.call_statistics(calls).first()) == {0}
    latencies = op.latency_statistics(calls).first()
    assert (latencies["calls"], latencies["p99_ms"], latencies["calls_per_second"]) == (0, None, 0)
    assert op.rolling_p99(calls, "context", ["called_at"], "latency_ms").count() == 0
    assert op.recent_throughput(calls, "context").count() == 0
    assert tuple(op.filter_rate(calls, F.col("ok")).first()) == (0, 0, 0)
    batches = spark.createDataFrame([], "rows bigint, bytes bigint, flush_ms bigint")
    assert set(op.batch_sizes(batches).first()) == {0}
    assert set(sinks.sink_totals(batches).first()) == {0}


def test_filter_rate(spark):
    row = op.filter_rate(spark.range(8), F.col("id") < 2).first()
    assert tuple(row) == (8, 2, 0.25)
