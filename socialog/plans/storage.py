"""Stored forms that lookups and joins read less of: postings, Bloom filters, buckets, bitmaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from socialog.operators import distinct_users, postings, reconcile
from socialog.plans import fixtures as fx
from socialog.plans.catalog import query
from socialog.plans.state import LIVE_SQL
from socialog.session import new_path
from socialog.sources import buckets, compaction, schemas, sinks

MENTIONED = 7
SITE = "https://www."


def _postings(spark, sf):
    """Postings of the live casts, stored by term."""
    log, path = fx.casts(spark, sf), new_path(spark, "postings")
    postings.write_postings(postings.live_postings(postings.postings(log), log), path, row_group=500)
    return spark.read.parquet(path)


_EMBEDDED = """SELECT Fid, Hash, Timestamp,
                      unnest(regexp_extract_all(Embeds, '"url": "([^"]*)"', 1)) AS url FROM live_casts"""


@query("postings", f"""
    SELECT 'mention' AS Kind, m AS Term, Timestamp, Fid, Hash FROM (
        SELECT *, unnest(list_distinct(string_split(Mentions, ','))) AS m FROM live_casts WHERE Mentions <> '')
    UNION ALL SELECT DISTINCT 'url', url, Timestamp, Fid, Hash FROM ({_EMBEDDED})
    UNION ALL SELECT DISTINCT 'host', lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)), Timestamp, Fid, Hash
              FROM ({_EMBEDDED})
    UNION ALL SELECT 'parent', ParentCastId, Timestamp, Fid, Hash FROM live_casts WHERE ParentCastId <> ''
    UNION ALL SELECT 'parent', ParentUrl, Timestamp, Fid, Hash FROM live_casts WHERE ParentUrl <> ''""",
    ("live_casts",))
def _(spark, sf):
    return _postings(spark, sf)


@query(
    "casts_mentioning_by_postings",
    f"SELECT * FROM live_casts WHERE list_contains(string_split(Mentions, ','), '{MENTIONED}')",
    ("live_casts",),
)
def _(spark, sf):
    found = postings.of_term(_postings(spark, sf), postings.MENTION, MENTIONED)
    return postings.casts_of(found, fx.casts(spark, sf))


@query(
    "casts_by_parent_by_postings",
    "SELECT * FROM live_casts WHERE ParentCastId = '3:0x' || md5('c:3:0')",
    ("live_casts",),
)
def _(spark, sf):
    parent = spark.range(1).select(F.concat(F.lit("3:"), fx.digest("c:", F.lit(3), ":", F.lit(0)))).first()[0]
    found = postings.of_term(_postings(spark, sf), postings.PARENT, parent)
    return postings.casts_of(found, fx.casts(spark, sf))


@query(
    "newest_casts_linking_a_site",
    f"""SELECT * FROM live_casts WHERE Embeds LIKE '%"url": "{SITE}%'
        ORDER BY Timestamp DESC, Fid, Hash LIMIT 100""",
    ("live_casts",),
)
def _(spark, sf):
    found = postings.of_prefix(_postings(spark, sf), postings.URL, SITE)
    return postings.newest_casts_of(found, fx.casts(spark, sf), 100)


@query(
    "cast_by_hash_with_bloom_filter",
    "SELECT * FROM casts WHERE Hash = '0x' || md5('c:0:1')",
    ("casts",),
)
def _(spark, sf):
    path = new_path(spark, "lookup")
    sinks.write_lookup(fx.casts(spark, sf).repartition(8, "Fid"), path, ["Hash", "TargetHash"], row_group=100)
    wanted = fx.digest("c:", F.lit(0), ":", F.lit(1))
    digest = spark.range(1).select(wanted).first()[0]
    return spark.read.schema(schemas.CASTS).parquet(path).filter(F.col("Hash") == digest)


def _bucketed(spark, sf):
    return buckets.store_casts(fx.casts(spark, sf), new_path(spark, "buckets"), 8)


@query("live_casts_bucketed", LIVE_SQL["casts"], ("live_casts",))
def _(spark, sf):
    adds, removed, _ = _bucketed(spark, sf)
    return buckets.live_casts(adds, removed)


@query(
    "replies_bucketed",
    """SELECT a.Fid, a.Hash, a.Timestamp, a.pf AS ParentFid, a.ph AS ParentHash,
              p.Timestamp AS ParentTimestamp, a.Timestamp - p.Timestamp AS DelaySeconds
       FROM (SELECT *, CAST(split_part(ParentCastId, ':', 1) AS BIGINT) AS pf,
                    split_part(ParentCastId, ':', 2) AS ph
             FROM live_casts WHERE ParentCastId <> '') a
       LEFT JOIN live_casts p ON p.Fid = a.pf AND p.Hash = a.ph""",
    ("live_casts",),
)
def _(spark, sf):
    adds, removed, answers = _bucketed(spark, sf)
    return buckets.replies(answers, buckets.live_casts(adds, removed), removed)


@query("cast_by_hash_of_bucket", "SELECT * FROM casts WHERE Hash = '0x' || md5('c:3:0')", ("casts",))
def _(spark, sf):
    adds, _, _ = _bucketed(spark, sf)
    digest = spark.range(1).select(fx.digest("c:", F.lit(3), ":", F.lit(0))).first()[0]
    return buckets.casts_by_hash(adds, digest)


@query(
    "lost_and_repeated_events",
    """SELECT id, 1 AS sent, CASE WHEN id % 97 = 5 THEN 0 ELSE 2 END AS got FROM stream_events
       WHERE id % 97 = 5 OR id % 211 = 7""",
    ("stream_events",),
)
def _(spark, sf):
    """Some delivered events are missing, others are there twice."""
    events = fx.events(spark, sf).select("id")
    twice = F.when(F.col("id") % 97 == 5, 0).when(F.col("id") % 211 == 7, 2).otherwise(1)
    got = events.select("id", F.explode(F.array_repeat(F.lit(0), twice)).alias("copy"))
    path = new_path(spark, "delivered")
    sinks.clustered(got.select("id"), "id").write.parquet(path)
    return reconcile.differences(events, spark.read.parquet(path), "id", fan=16, leaf=32)


_DAY = "CAST(to_timestamp(Timestamp + 1609459200) AT TIME ZONE 'UTC' AS DATE)"


def _daily(spark, sf):
    """Daily users by shard: the first half of the log, then all of it again."""
    log = fx.reactions(spark, sf).withColumn("shard", F.col("Fid") % 3)
    half = log.agg(F.expr("(min(Timestamp) + max(Timestamp)) div 2")).first()[0]
    parts = [distinct_users.daily_users(rows, ["shard"]) for rows in (log.filter(F.col("Timestamp") < half), log)]
    path = new_path(spark, "daily")
    distinct_users.merged(*parts).write.parquet(path)
    return spark.read.parquet(path)


@query(
    "users_per_day",
    f"""SELECT {_DAY} AS day, count(DISTINCT Fid) AS users FROM reactions GROUP BY 1""",
    ("reactions",),
)
def _(spark, sf):
    return distinct_users.distinct_users(_daily(spark, sf), ["day"])


@query(
    "users_of_a_span_by_shard",
    f"""SELECT Fid % 3 AS shard, count(DISTINCT Fid) AS users FROM reactions
        WHERE {_DAY} BETWEEN (SELECT min({_DAY}) + 3 FROM reactions) AND (SELECT min({_DAY}) + 12 FROM reactions)
        GROUP BY 1""",
    ("reactions",),
)
def _(spark, sf):
    daily = _daily(spark, sf)
    first = daily.agg(F.min("day")).first()[0]
    span = daily.filter(F.col("day").between(F.date_add(F.lit(first), 3), F.date_add(F.lit(first), 12)))
    return distinct_users.distinct_users(span, ["shard"])


@query("compacted_in_order", "SELECT * FROM reactions", ("reactions",))
def _(spark, sf):
    """Many small files by user, compacted twice."""
    folder = new_path(spark, "small-files")
    in_order = fx.reactions(spark, sf).repartitionByRange(24, "Fid", "Hash").sortWithinPartitions("Fid")
    in_order.write.parquet(folder)
    for target in (1 << 16, 1 << 20):
        compaction.compact(spark, folder, schemas.REACTIONS, "Fid", target)
    return compaction.read(spark, folder, schemas.REACTIONS)

