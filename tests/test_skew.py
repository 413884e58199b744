"""A third of all rows on one key: the join splits it and loses nothing."""

import pytest
from conftest import final_plan
from helpers import flat, link
from pyspark.sql import functions as F

from socialog.operators import graph, state
from socialog.sources import schemas

TIGHT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.shuffle.partitions": "8",
}
N = 30_000


@pytest.fixture
def tight(settings):
    settings(TIGHT)


def spread(spark, n=N):
    return spark.range(0, n, 1, 16)


def log(df, kind, **columns):
    return df.select(*schemas.build(schemas.FLAT[kind], columns))


def test_live_splits_a_hot_key(spark, tight):
    hot = F.col("id") % 3 == 0
    rows = log(
        spread(spark),
        "links",
        Fid=F.when(hot, 1).otherwise(F.col("id")),
        MessageType=F.lit("LinkAdd"),
        Timestamp=F.lit(7),
        Hash=F.sha2(F.col("id").cast("string"), 256),
        LinkType=F.lit("follow"),
        TargetFid=F.lit(5),
    )
    live = state.live_links(rows)
    assert "skew=true" in final_plan(live)
    assert live.count() == N
    assert live.select("Hash").distinct().count() == N


def test_removal_splits_copies_of_one_cast(spark, tight):
    hot = F.col("id") % 3 == 0
    adds = log(
        spread(spark),
        "casts",
        Fid=F.col("id"),
        MessageType=F.lit("CastAdd"),
        Hash=F.when(hot, "0xhot").otherwise(F.sha2(F.col("id").cast("string"), 256)),
        Text=F.sha2(F.col("id").cast("string"), 512),
    )
    removes = log(
        spread(spark),
        "casts",
        MessageType=F.lit("CastRemove"),
        Hash=F.sha2((F.col("id") + N).cast("string"), 256),
        TargetHash=F.lit("0xgone"),
    )
    live = state.live_casts(adds.unionByName(removes))
    assert "skew=true" in final_plan(live)
    assert live.count() == N


def test_removed_copies_collapse_before_the_join(spark):
    removes = flat(
        spark, "casts",
        [{"MessageType": "CastRemove", "TargetHash": "x", "Hash": str(i)} for i in range(500)],
    )
    kept = state.spread_distinct(removes, "TargetHash", F.col("Hash")).count()
    assert 1 <= kept <= state.SPREAD


def test_replies_split_a_popular_parent(spark, tight):
    hot = F.col("id") % 3 == 0
    parent = F.when(hot, "0:0xhot").otherwise(F.concat(F.lit("0:"), F.col("id").cast("string")))
    rows = log(
        spread(spark),
        "casts",
        Fid=F.col("id"),
        Hash=F.sha2(F.col("id").cast("string"), 256),
        Timestamp=F.col("id"),
        ParentCastId=parent,
    )
    found = graph.replies(rows)
    assert "skew=true" in final_plan(found)
    assert found.count() == N


def test_ranked_form_prunes_before_the_shuffle(spark):
    rows = flat(spark, "links", [link(1, 2, i, True, str(i)) for i in range(50)])
    plan = final_plan(state.live_links(rows, how=state.live_ranked))
    assert "WindowGroupLimit" in plan and "Partial" in plan
