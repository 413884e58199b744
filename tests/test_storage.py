"""What stored forms spare: row groups, buckets, shuffles, ranges and files that are not read."""

import random
import re

import pytest
from conftest import DATA, final_plan
from helpers import flat, hashes, link
from pyspark.sql import functions as F

from socialog.operators import distinct_users, graph, postings, reconcile, state
from socialog.plans import fixtures as fx
from socialog.sources import buckets, compaction, schemas, sinks


def rows_scanned(df) -> int:
    """Rows that the scans of a plan without a shuffle gave out: those of the row groups read."""
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    df._jdf.collectToPython()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


# Postings


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("postings") / "all")
    log = fx.casts(spark, DATA)
    postings.write_postings(postings.live_postings(postings.postings(log), log), path, row_group=50)
    return spark.read.parquet(path)


@pytest.mark.parametrize("find", [
    lambda p: postings.of_term(p, postings.MENTION, 7), lambda p: postings.of_prefix(p, postings.URL, "https://www."),
])
def test_a_lookup_reads_the_row_groups_of_its_term(stored, find):
    found = find(stored)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(Kind," in plan
    assert found.count() > 0
    assert rows_scanned(found) <= max(stored.count() / 3, found.count() + 100)


def test_terms_of_awkward_casts(spark):
    def cast(digest, mentions="", embeds="", kind="CastAdd", target=""):
        return {"Fid": 1, "MessageType": kind, "Timestamp": 1, "Hash": digest, "Text": "", "Mentions": mentions,
                "Embeds": embeds, "TargetHash": target}

    one, other = '{ "url": "https://A.example/x" }', '{ "url": "not a url" }'
    schema = schemas.CASTS
    given = [cast("0xa", "3,3,4", f"{one}|{one}|{other}"), cast("0xb"), cast("0xc", "3"), cast("0xd", kind="CastRemove", target="0xc")]
    blank = {f.name: 0 if f.dataType.typeName() == "long" else "" for f in schema.fields}
    log = spark.createDataFrame([tuple({**blank, **r}[f.name] for f in schema.fields) for r in given], schema)
    found = sorted(tuple(r) for r in postings.live_postings(postings.postings(log), log).collect())
    assert found == [
        ("host", "a.example", 1, 1, "0xa"), ("mention", "3", 1, 1, "0xa"), ("mention", "4", 1, 1, "0xa"),
        ("url", "https://A.example/x", 1, 1, "0xa"), ("url", "not a url", 1, 1, "0xa"),
    ]


def test_keys_of_a_page_reach_the_scan_of_the_casts(spark, stored):
    page = postings.newest_casts_of(postings.of_prefix(stored, postings.URL, "http"), fx.casts(spark, DATA), 3)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "In(Fid" in plan and "Exchange" not in plan
    assert page.count() == 3


# Bloom filters


def test_bloom_filters_skip_row_groups(spark, tmp_path):
    casts = fx.casts(spark, DATA).repartition(4, "Fid")
    digest = casts.filter("MessageType = 'CastAdd'").first()["Hash"]
    sinks.write_lookup(casts, str(tmp_path / "with"), ["Hash"], row_group=40)
    casts.write.option("parquet.block.row.count.limit", 40).option("parquet.enable.dictionary", "false").parquet(str(tmp_path / "without"))
    reads = {}
    for name in ("with", "without"):
        found = spark.read.parquet(str(tmp_path / name)).filter(F.col("Hash") == digest)
        assert found.count() == 1
        reads[name] = rows_scanned(found)
    assert reads["with"] <= 2 * 40  # its own row group, and a false hit at most
    assert reads["without"] > casts.count() / 2


# Buckets


@pytest.fixture(scope="module")
def bucketed(spark, tmp_path_factory):
    return buckets.store_casts(fx.casts(spark, DATA), str(tmp_path_factory.mktemp("buckets")), 4)


@pytest.fixture
def no_broadcast(settings):
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})


def test_joins_of_buckets_do_not_shuffle(spark, no_broadcast, bucketed):
    adds, removed, answers = bucketed
    live = buckets.live_casts(adds, removed)
    assert "Exchange" not in final_plan(live)
    assert hashes(live) == hashes(state.live_casts(fx.casts(spark, DATA)))
    joined = final_plan(buckets.replies(answers, live, removed)).split("== Initial Plan ==")[0]
    assert len(re.findall(r"Exchange hashpartitioning", joined)) <= 2  # answers by their own hash, removed hashes
    wanted = graph.replies(state.live_casts(fx.casts(spark, DATA)))
    found = buckets.replies(answers, live, removed)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, wanted.collect()), key=repr)


@pytest.fixture
def buckets_shown(settings):
    """Scans that gain nothing else from buckets say which they read."""
    settings({"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"})


def test_a_lookup_reads_one_bucket(spark, buckets_shown, bucketed):
    adds, _, _ = bucketed
    digest = adds.first()["Hash"]
    found = buckets.casts_by_hash(adds, digest)
    assert "SelectedBucketsCount: 1 out of 4" in found._jdf.queryExecution().executedPlan().toString()
    assert [r["Hash"] for r in found.collect()] == [digest]


def test_buckets_reopened(spark, buckets_shown, tmp_path):
    rows = spark.range(100).select(F.col("id").cast("string").alias("Hash"))
    path = str(tmp_path / "t")
    buckets.store(rows, path, "Hash", 4)
    again = buckets.reopen(spark, path, "Hash", 4, "Hash STRING")
    assert "SelectedBucketsCount: 1 out of 4" in again.filter("Hash = '7'")._jdf.queryExecution().executedPlan().toString()
    assert again.filter("Hash = '7'").count() == 1 and again.count() == 100


# Reconciliation


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id long")


@pytest.mark.parametrize("seed", range(3))
def test_differences_match_a_count(spark, seed):
    rng = random.Random(seed)
    a = [rng.randrange(-500, 5000) for _ in range(900)]
    b = [v for v in a if rng.random() > 0.01] + [rng.randrange(6000) for _ in range(4)]
    wanted = {(v, a.count(v), b.count(v)) for v in {*a, *b} if a.count(v) != b.count(v)}
    found = reconcile.differences(ids(spark, [*a, None]), ids(spark, b), "id", fan=8, leaf=16)
    assert {tuple(r) for r in found.collect()} == wanted


def test_equal_sides_and_empty_sides(spark):
    same = ids(spark, range(300))
    assert reconcile.differing(same, same, "id", fan=4, leaf=8) == []
    assert reconcile.differences(same, same, "id").count() == 0
    assert reconcile.differences(same.limit(0), same.limit(0), "id").count() == 0
    assert reconcile.differences(same.limit(0), same, "id", fan=4, leaf=8).count() == 300


def test_equal_ranges_are_not_read_again(spark, tmp_path):
    for name, values in (("a", range(20_000)), ("b", [v for v in range(20_000) if v != 12_345])):
        path = str(tmp_path / name)
        sinks.clustered(ids(spark, values), "id").write.option("parquet.block.row.count.limit", 500).parquet(path)
    a, b = (spark.read.parquet(str(tmp_path / name)) for name in "ab")
    (found,) = reconcile.differing(a, b, "id", fan=16, leaf=100)
    assert found[0] <= 12_345 <= found[1] and found[1] - found[0] < 100
    listed = a.filter(reconcile._within([found], F.col("id")))
    assert rows_scanned(listed) <= 1000
    assert [tuple(r) for r in reconcile.differences(a, b, "id", fan=16, leaf=100).collect()] == [(12_345, 1, 0)]


def test_many_ranges_that_differ_are_listed_at_once(spark, monkeypatch):
    monkeypatch.setattr(reconcile, "MOST", 3)
    a, b = ids(spark, range(1000)), ids(spark, range(0, 1000, 2))
    assert reconcile.differences(a, b, "id", fan=8, leaf=2).count() == 500


# Distinct users


def test_users_of_days_add_up_to_users_of_a_span(spark):
    rng = random.Random(1)
    rows = [(rng.choice([1, 5, 40_000, 10**12]) + rng.randrange(3), rng.randrange(5) * 86_400) for _ in range(300)]
    log = spark.createDataFrame([*rows, (None, 0)], "Fid long, Timestamp long")
    daily = distinct_users.daily_users(log)
    assert distinct_users.distinct_users(daily).first()["users"] == len({f for f, _ in rows})
    assert {r["users"] for r in distinct_users.distinct_users(daily, ["day"]).collect()} == {
        len({f for f, at in rows if at == day}) for day in {at for _, at in rows}
    }
    again = distinct_users.merged(daily, distinct_users.daily_users(log.limit(50)))
    assert distinct_users.distinct_users(again).first()["users"] == len({f for f, _ in rows})
    assert distinct_users.distinct_users(distinct_users.daily_users(log.limit(0))).first()["users"] == 0


# Compaction


def test_planned_groups_are_neighbours_within_the_target():
    def file(name, size, low):
        return compaction.File(name, size, low, low)

    files = [file("a", 10, 1), file("b", 20, 2), file("big", 60, 3), file("c", 30, 4), file("d", 40, 5), file("e", 45, 6), file("n", 5, None)]
    groups = [[f.path for f in g] for g in compaction.planned(files, 100)]
    assert groups == [["n", "a", "b"], ["c", "d"]]
    assert compaction.planned([], 100) == []


def test_compaction_keeps_large_files_and_key_ranges(spark, tmp_path):
    folder = str(tmp_path / "log")
    rows = flat(spark, "links", [link(f, t, t, digest=f"0x{f}-{t}") for f in range(40) for t in range(30)])
    wide = rows.withColumn("Signature", F.repeat(F.sha2("Hash", 512), 4))
    wide.filter("Fid >= 20").coalesce(1).write.parquet(folder)
    small = rows.filter("Fid < 20").repartitionByRange(20, "Fid").sortWithinPartitions("Fid")
    small.write.mode("append").parquet(folder)
    schema = schemas.LINKS
    before = {f.path: f for f in compaction.files_in_use(spark, folder, schema, "Fid")}
    large = max(before.values(), key=lambda f: f.bytes)
    target = 2 * large.bytes
    assert compaction.compact(spark, folder, schema, "Fid", target) == len(before) - 1
    after = {f.path: f for f in compaction.files_in_use(spark, folder, schema, "Fid")}
    assert after[large.path] == large and len(after) < len(before)
    assert all(f.high < 20 for f in after.values() if f.path != large.path)
    assert hashes(compaction.read(spark, folder, schema)) == hashes(rows)
    assert compaction.compact(spark, folder, schema, "Fid", target) == 0
    assert hashes(spark.read.schema(schema).parquet(f"{folder}/*.parquet")) == hashes(rows)  # old files stay
