"""Documented analyses of the current-state tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from socialog.functions import clock
from socialog.operators.filters import text_match


def _count(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def _day() -> Column:
    return clock.day_of(F.col("Timestamp"))


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(_count(name))


def per_day(df: DataFrame, day: str, count: str) -> DataFrame:
    return df.groupBy(_day().alias(day)).agg(_count(count)).orderBy(day)


def per_month(df: DataFrame, month: str, count: str) -> DataFrame:
    return (
        df.groupBy(clock.month_start(F.col("Timestamp")).alias("_month"))
        .agg(_count(count))
        .select(clock.month_text(F.col("_month")).alias(month), count)
        .orderBy(month)
    )


def reply_share(casts: DataFrame) -> DataFrame:
    """Percent of casts that answer another cast (blank means none)."""
    is_reply = F.when(F.col("ParentCastId") != "", 1).otherwise(0)
    return casts.agg((F.avg(is_reply) * 100).alias("reply_pct"))


def reactions_by_type(reactions: DataFrame) -> DataFrame:
    return reactions.groupBy("ReactionType").agg(_count("reaction_count"))


def reactions_per_day(reactions: DataFrame) -> DataFrame:
    return (
        reactions.groupBy(_day().alias("reaction_date"), "ReactionType")
        .agg(_count("daily_reaction_count"))
        .orderBy("reaction_date", "ReactionType")
    )


def reactions_by_month(reactions: DataFrame) -> DataFrame:
    """Months down, reaction types across; 0 rows of a type read NULL."""
    return (
        reactions.groupBy(clock.month_start(F.col("Timestamp")).alias("_month"))
        .pivot("ReactionType", ["Like", "Recast"])
        .agg(F.count(F.lit(1)))
        .select(clock.month_text(F.col("_month")).alias("month"), "Like", "Recast")
        .orderBy("month")
    )


def key_counts(df: DataFrame, key: str, count: str) -> DataFrame:
    return df.groupBy(key).agg(_count(count))


def top(df: DataFrame, key: str, count: str, limit: int) -> DataFrame:
    """The ``limit`` most frequent keys; equal counts go by key."""
    return (
        key_counts(df, key, count)
        .orderBy(F.col(count).desc(), F.col(key).asc())
        .limit(limit)
    )


def top_posters(casts: DataFrame, limit: int = 10) -> DataFrame:
    return top(casts, "Fid", "cast_count", limit)


def top_reactors(reactions: DataFrame, limit: int = 20) -> DataFrame:
    return top(reactions, "Fid", "reaction_count", limit)


def top_targets(reactions: DataFrame, limit: int = 10) -> DataFrame:
    return top(reactions, "TargetCastId", "reaction_count", limit)


def top_followed(links: DataFrame, limit: int = 20) -> DataFrame:
    return top(links, "TargetFid", "follower_count", limit)


def top_followers(links: DataFrame, limit: int = 20) -> DataFrame:
    return top(links, "Fid", "following_count", limit)


def linked_casts(casts: DataFrame, limit: int = 100) -> DataFrame:
    """Casts whose embeds hold a URL."""
    return text_match(casts, "Embeds", "%url%", ["Hash"], limit)
