import random

import pytest
from pyspark.sql import functions as F

from socialog.operators import ordering


pytestmark = pytest.mark.usefixtures("many_tasks")


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(5)
    rows = [(0 if i % 3 == 0 else rng.randrange(40), rng.randrange(1000), i) for i in range(3000)]
    return spark.createDataFrame(rows, "g bigint, v bigint, id bigint").repartition(7)


def test_row_index_is_dense_and_ordered(frame):
    rows = ordering.row_index(frame, "v", "id").collect()
    by_index = sorted(rows, key=lambda r: r["row_index"])
    assert [r["row_index"] for r in by_index] == list(range(3000))
    assert [r["id"] for r in by_index] == [r["id"] for r in sorted(rows, key=lambda r: (r["v"], r["id"]))]


def test_copies_are_spread_over_tasks(spark):
    copies = spark.range(2000).select(F.lit(1).alias("v")).repartition(5)
    per_task = ordering._placed(copies, ["v"]).groupBy("_task").count().collect()
    assert len(per_task) == 4 and max(r["count"] for r in per_task) < 1000
    found = sorted(r["row_index"] for r in ordering.row_index(copies, "v").collect())
    assert found == list(range(2000))


@pytest.mark.parametrize("hot_rows", [1, 100, 1_000_000])
def test_group_index_restarts_in_each_group(frame, hot_rows):
    seen = {}
    rows = ordering.group_index(frame, ["g"], F.col("v").desc(), "id", hot_rows=hot_rows).collect()
    for r in rows:
        seen.setdefault(r["g"], []).append((r["group_index"], -r["v"], r["id"]))
    assert sum(map(len, seen.values())) == 3000
    for members in seen.values():
        members.sort()
        assert [m[0] for m in members] == list(range(len(members)))
        assert [m[1:] for m in members] == sorted(m[1:] for m in members)


@pytest.mark.parametrize("hot_rows", [1, 10])
def test_group_index_keeps_null_groups(spark, hot_rows):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, v int")
    rows = ordering.group_index(df, ["g"], "v", hot_rows=hot_rows).collect()
    assert sorted((r["v"], r["group_index"]) for r in rows) == [(1, 0), (2, 1), (3, 0)]


def test_groups_are_numbered_with_one_shuffle(frame):
    plan = ordering.group_index(frame, ["g"], "v", "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_a_hot_group_is_spread_over_tasks(spark, settings):
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    hot = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1)).alias("g"), "id").repartition(5)
    numbered = ordering.group_index(hot, ["g"], "id", hot_rows=100)
    tasks = numbered.filter("g = -1").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 4 and max(r["count"] for r in tasks) < 1500
    found = numbered.filter("g = -1").orderBy("id").collect()
    assert [r["group_index"] for r in found] == list(range(len(found)))


def test_numbering_nothing(spark):
    none = spark.range(0)
    assert ordering.row_index(none, "id").count() == 0
    assert ordering.group_index(none, ["id"], "id").count() == 0
    assert ordering.even_parts(none, 3, "id").count() == 0
    assert ordering.page(none, ["id"], 3).next_token is None


@pytest.mark.parametrize("rows, parts", [(10, 3), (3, 5), (12, 4), (1, 1), (7, 7)])
def test_even_parts_differ_by_at_most_one(spark, rows, parts):
    found = ordering.even_parts(spark.range(rows), parts, "id").orderBy("id").collect()
    labels = [r["part"] for r in found]
    sizes = [labels.count(p + 1) for p in range(parts)]
    assert labels == sorted(labels)
    assert sizes == [rows // parts + (p < rows % parts) for p in range(parts)]


@pytest.mark.parametrize("reverse", [False, True])
def test_pages_walk_all_rows_once(frame, reverse):
    keys, token, seen = ["v", "id"], None, []
    while True:
        page = ordering.page(frame, keys, 700, token, reverse)
        seen += [(r["v"], r["id"]) for r in page.rows.collect()]
        token = page.next_token
        if token is None:
            break
    assert len(seen) == 3000
    assert seen == sorted(seen, reverse=reverse)


def test_last_full_page_has_no_token(spark):
    assert ordering.page(spark.range(10), ["id"], 10).next_token is None
    assert ordering.page(spark.range(11), ["id"], 10).next_token == (9,)


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums_over_blocks(spark, descending):
    df = spark.createDataFrame([(s, s * 2 + 1) for s in range(0, 97, 3)], "s bigint, v bigint")
    found = {
        r["s"]: r["v"]
        for r in ordering.running_sums(df, "s", ["v"], width=10, descending=descending).collect()
    }
    total, want = 0, {}
    for s in sorted(found, reverse=descending):
        total += s * 2 + 1
        want[s] = total
    assert found == want
