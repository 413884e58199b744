"""Replies, mentions and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from socialog.functions import codec


def replies(casts: DataFrame) -> DataFrame:
    """Casts that answer another cast, with the parent where it is known.

    Copies of a parent collapse before the join, so a reply has one parent row.
    Roots are left out before the join; their blank key would be one hot group.
    """
    parsed = codec.parse_cast_id(F.col("ParentCastId"))
    answers = casts.filter(F.col("ParentCastId") != "").select(
        "Fid",
        "Hash",
        "Timestamp",
        parsed["fid"].alias("ParentFid"),
        parsed["hash"].alias("ParentHash"),
    )
    # Grouped by the time too, so the join below gets a plain shuffle on both
    # sides and can split a parent with very many replies.
    parents = casts.select(
        F.col("Fid").alias("ParentFid"),
        F.col("Hash").alias("ParentHash"),
        F.col("Timestamp").alias("ParentTimestamp"),
    ).distinct()
    return answers.join(parents, ["ParentFid", "ParentHash"], "left").select(
        "Fid",
        "Hash",
        "Timestamp",
        "ParentFid",
        "ParentHash",
        "ParentTimestamp",
        (F.col("Timestamp") - F.col("ParentTimestamp")).alias("DelaySeconds"),
    )


def user_edges(casts: DataFrame) -> DataFrame:
    """Who mentions and who answers whom, with counts."""
    mentions = casts.select(
        F.col("Fid").alias("Src"),
        F.explode(codec.parse_mentions(F.col("Mentions"))).alias("Dst"),
        F.lit("mention").alias("Kind"),
    )
    answers = casts.filter(F.col("ParentCastId") != "").select(
        F.col("Fid").alias("Src"),
        codec.parse_cast_id(F.col("ParentCastId"))["fid"].alias("Dst"),
        F.lit("reply").alias("Kind"),
    )
    return (
        mentions.unionByName(answers)
        .groupBy("Src", "Dst", "Kind")
        .agg(F.count(F.lit(1)).alias("N"))
    )


def reconcile(source: DataFrame, sink: DataFrame, key: list[str]) -> DataFrame:
    """Ids lost, ids never sent and ids delivered more than once.

    Both sides are tagged and counted in one aggregate; nothing is joined.
    """

    def tagged(df: DataFrame, sent: int, got: int) -> DataFrame:
        return df.select(*key, F.lit(sent).alias("_sent"), F.lit(got).alias("_got"))

    counts = (
        tagged(source, 1, 0)
        .unionByName(tagged(sink, 0, 1))
        .groupBy(*key)
        .agg(F.sum("_sent").alias("_sent"), F.sum("_got").alias("_got"))
    )
    sent, got = F.col("_sent"), F.col("_got")
    return counts.agg(
        F.count_if(sent > 0).alias("source_ids"),
        F.count_if(got > 0).alias("sink_ids"),
        F.count_if((sent > 0) & (got == 0)).alias("missing"),
        F.count_if((sent == 0) & (got > 0)).alias("unexpected"),
        F.count_if(got > 1).alias("duplicated"),
    )
