"""Keyed lookups. Each is a filter; page the result with ``ordering.page``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from socialog.operators.filters import of_fid


def _cast_ref(cast_id: tuple[int, str]) -> str:
    fid, digest = cast_id
    return f"{fid}:{digest}"


def _maybe(df: DataFrame, column: str, value) -> DataFrame:
    return df if value is None else df.filter(F.col(column) == value)


def by_fid(log: DataFrame, fid: int) -> DataFrame:
    return of_fid(log, fid)


def casts_by_parent(
    casts: DataFrame, cast_id: tuple[int, str] | None = None, url: str | None = None
) -> DataFrame:
    """Answers to one cast or to one URL."""
    if (cast_id is None) == (url is None):
        raise ValueError("give either cast_id or url")
    if url is not None:
        return casts.filter(F.col("ParentUrl") == url)
    return casts.filter(F.col("ParentCastId") == _cast_ref(cast_id))


def casts_mentioning(casts: DataFrame, fid: int) -> DataFrame:
    return casts.filter(F.array_contains(F.split("Mentions", ","), str(fid)))


def cast_by_id(casts: DataFrame, fid: int, digest: str) -> DataFrame:
    return casts.filter((F.col("Fid") == fid) & (F.col("Hash") == digest))


def reactions_by_fid(reactions: DataFrame, fid: int, kind: str | None = None) -> DataFrame:
    return _maybe(of_fid(reactions, fid), "ReactionType", kind)


def reactions_by_target(
    reactions: DataFrame,
    cast_id: tuple[int, str] | None = None,
    url: str | None = None,
    kind: str | None = None,
) -> DataFrame:
    if (cast_id is None) == (url is None):
        raise ValueError("give either cast_id or url")
    column, value = ("TargetUrl", url) if url is not None else ("TargetCastId", _cast_ref(cast_id))
    return _maybe(reactions.filter(F.col(column) == value), "ReactionType", kind)


def reaction(
    reactions: DataFrame,
    fid: int,
    kind: str,
    cast_id: tuple[int, str] | None = None,
    url: str | None = None,
) -> DataFrame:
    return of_fid(reactions_by_target(reactions, cast_id, url, kind), fid)


def links_by_fid(links: DataFrame, fid: int, kind: str | None = None) -> DataFrame:
    return _maybe(of_fid(links, fid), "LinkType", kind)


def links_by_target(links: DataFrame, target: int, kind: str | None = None) -> DataFrame:
    return _maybe(links.filter(F.col("TargetFid") == target), "LinkType", kind)


def link(links: DataFrame, fid: int, kind: str, target: int) -> DataFrame:
    return links_by_target(of_fid(links, fid), target, kind)


def user_data(profiles: DataFrame, fid: int, field: str | None = None) -> DataFrame:
    """Newest value of each profile field of one user, or of one field."""
    chosen = _maybe(of_fid(profiles, fid), "UserDataType", field)
    age = F.struct("Timestamp", "Hash")
    return chosen.groupBy("Fid", "UserDataType").agg(
        F.max_by("Value", age).alias("Value"),
        F.max("Timestamp").alias("Timestamp"),
    )


def verifications(rows: DataFrame, fid: int, address: str | None = None) -> DataFrame:
    return _maybe(rows.filter(F.col("fid") == fid), "address", address)


def fids_of_shard(
    shards: DataFrame, shard: int, size: int | None = None, reverse: bool = False
) -> DataFrame:
    order = F.col("Fid").desc() if reverse else F.col("Fid").asc()
    fids = shards.filter(F.col("shard") == shard).select("Fid").distinct().orderBy(order)
    return fids if size is None else fids.limit(size)


def event_by_id(events: DataFrame, event_id: int) -> DataFrame:
    return events.filter(F.col("id") == event_id)


def address_roles(custody: DataFrame, verified: DataFrame) -> DataFrame:
    """Custody, auth and verified flags of every (fid, address).

    ``custody`` holds fid, custody_address and auth_address; ``verified`` holds
    fid and address. The three lists are stacked and folded in one aggregate.
    """

    def flagged(df: DataFrame, column: str, role: str) -> DataFrame:
        return df.select(
            "fid",
            F.col(column).alias("address"),
            *[F.lit(name == role).alias(name) for name in ROLES],
        )

    return (
        flagged(custody, "custody_address", "is_custody")
        .unionByName(flagged(custody, "auth_address", "is_auth"))
        .unionByName(flagged(verified, "address", "is_verified"))
        .groupBy("fid", "address")
        .agg(*[F.bool_or(name).alias(name) for name in ROLES])
    )


ROLES = ("is_custody", "is_auth", "is_verified")


def address_role(custody: DataFrame, verified: DataFrame, fid: int, address: str) -> DataFrame:
    return address_roles(custody, verified).filter(
        (F.col("fid") == fid) & (F.col("address") == address)
    )
