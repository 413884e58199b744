"""From the add/remove log to current state.

A latest-event rule keeps every row tied on the newest second of its key, so an
add tied with a remove survives. It is written as an aggregate (map-side
combine, narrow shuffle) and a semi join on key *and* second: no task ever
holds a whole key, and both join inputs are plain shuffles, which adaptive
execution may split when one key and second is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from socialog.functions import codec

REACTION_KEY = ("Fid", "TargetCastId", "ReactionType")
REACTION_KEY_WITH_URL = (*REACTION_KEY, "TargetUrl")
LINK_KEY = ("Fid", "TargetFid", "LinkType")
VERIFICATION_KEY = ("Fid", "Address")

# Profile fields of the wide table, in column order.
WIDE_FIELDS = ("Username", "Display", "Location", "Pfp", "Bio", "Twitter")

SPREAD = 64


def latest_seconds(log: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Newest second of each key."""
    return log.groupBy(*key).agg(F.max("Timestamp").alias("Timestamp"))


def live(log: DataFrame, key: tuple[str, ...], add: str, remove: str) -> DataFrame:
    """Adds at the newest second of their key."""
    is_add = F.col("MessageType") == add
    newest = (
        log.filter(F.col("MessageType").isin(add, remove))
        .groupBy(*key)
        .agg(
            F.max("Timestamp").alias("Timestamp"),
            F.max(F.when(is_add, F.col("Timestamp"))).alias("_added"),
        )
        .filter(F.col("Timestamp") == F.col("_added"))
        .drop("_added")
    )
    return (
        log.filter(is_add).join(newest, [*key, "Timestamp"], "left_semi").select(*log.columns)
    )


def live_ranked(log: DataFrame, key: tuple[str, ...], add: str, remove: str) -> DataFrame:
    """The same rows by ``rank() = 1``: one scan and one shuffle.

    Spark keeps only the best rank of each key per map task before the shuffle
    (WindowGroupLimit). Prefer it where no key has very many rows at one second.
    Rows with a NULL in their key match nothing and are left out, as in ``live``.
    """
    newest_first = Window.partitionBy(*key).orderBy(F.col("Timestamp").desc())
    return (
        log.filter(F.col("MessageType").isin(add, remove))
        .dropna(subset=list(key))
        .withColumn("_rank", F.rank().over(newest_first))
        .filter((F.col("_rank") == 1) & (F.col("MessageType") == add))
        .drop("_rank")
    )


def live_joined(log: DataFrame, key: tuple[str, ...], add: str, remove: str) -> DataFrame:
    """The same rows in the literal form: newest second per key, inner join, keep adds."""
    events = log.filter(F.col("MessageType").isin(add, remove))
    newest = latest_seconds(events, key)
    return (
        events.join(newest, [*key, "Timestamp"])
        .filter(F.col("MessageType") == add)
        .select(*log.columns)
    )


def live_reactions(log: DataFrame, by_url: bool = False, how=live) -> DataFrame:
    """Current reactions.

    Reactions to URLs have no cast id, so by default all URL reactions of one
    user and type share a key; ``by_url`` makes the URL part of it.
    """
    key = REACTION_KEY_WITH_URL if by_url else REACTION_KEY
    return how(log, key, "ReactionAdd", "ReactionRemove")


def live_links(log: DataFrame, how=live) -> DataFrame:
    return how(log, LINK_KEY, "LinkAdd", "LinkRemove")


def spread_distinct(df: DataFrame, column: str, salt: Column) -> DataFrame:
    """At most ``SPREAD`` rows per value of ``column``.

    Copies collapse before and after a shuffle on (value, salt). The result is
    not partitioned by the value alone, so the join that follows still gets a
    plain shuffle on both sides and can split a hot value of the other side.
    """
    return (
        df.select(column, F.pmod(F.xxhash64(salt), F.lit(SPREAD)).alias("_salt"))
        .distinct()
        .drop("_salt")
    )


def live_casts(log: DataFrame) -> DataFrame:
    """Cast adds whose hash no remove names, whoever sent the remove."""
    removed = spread_distinct(
        log.filter(F.col("MessageType") == "CastRemove"), "TargetHash", F.col("Hash")
    ).withColumnRenamed("TargetHash", "Hash")
    return log.filter(F.col("MessageType") == "CastAdd").join(removed, "Hash", "left_anti").select(
        *log.columns
    )


def _field(kind: str) -> Column:
    return F.col("UserDataType") == kind


def wide_profiles(log: DataFrame) -> DataFrame:
    """One row per user; each field is the alphabetically highest value."""
    return log.groupBy("Fid").agg(
        *[F.max(F.when(_field(kind), F.col("Value"))).alias(kind) for kind in WIDE_FIELDS]
    )


def latest_profiles(log: DataFrame) -> DataFrame:
    """One row per user; each field is its newest value, ties by hash."""
    age = F.struct("Timestamp", "Hash")
    return log.groupBy("Fid").agg(
        *[
            F.max_by("Value", F.when(_field(kind), age)).alias(kind)
            for kind in WIDE_FIELDS
        ]
    )


def active_pro(tiers: DataFrame, now: int) -> DataFrame:
    """Users whose first Pro tier has not expired."""
    pro = F.filter("tier_subscriptions", lambda t: t["tier_type"] == "Pro")
    first = F.get(pro, F.lit(0))
    return tiers.select("fid", first["expires_at"].alias("expires_at")).filter(
        F.col("expires_at") > now
    )


def latest_addresses(verifications: DataFrame) -> DataFrame:
    """Newest verified Ethereum address per user; of several at that second the first listed.

    ``seq`` is the place in the list. Second 0 stands for no time and never counts.
    """
    return (
        verifications.filter(
            (F.col("type") == "VerificationAddEthAddress")
            & (F.col("protocol") == "Ethereum")
            & (F.col("timestamp") > 0)
        )
        .groupBy("fid")
        .agg(F.max_by("address", F.struct("timestamp", -F.col("seq"))).alias("address"))
    )


def live_verifications(log: DataFrame, how=live) -> DataFrame:
    """Addresses whose newest message adds them."""
    return how(log, VERIFICATION_KEY, "VerificationAddEthAddress", "VerificationRemove")


def listed_addresses(verifications: DataFrame) -> DataFrame:
    """Flat verification messages as the rows that ``latest_addresses`` and the lookups read.

    Of messages at one second the one with the smallest hash is listed first.
    """
    return verifications.select(
        F.col("Fid").alias("fid"),
        F.col("MessageType").alias("type"),
        F.col("Timestamp").alias("timestamp"),
        F.col("Address").alias("address"),
        F.col("Protocol").alias("protocol"),
        F.conv(F.substring("Hash", 3, 15), 16, 10).cast("long").alias("seq"),
    )


def pro_members(tiers: DataFrame, verifications: DataFrame, now: int) -> DataFrame:
    """Active pro members, each once, with their newest Ethereum address, ``""`` if none.

    Both sides are folded to one row per user before the join and share its
    partitioning.
    """
    return (
        active_pro(tiers, now)
        .select("fid")
        .distinct()
        .join(latest_addresses(verifications), "fid", "left")
        .select(
            F.col("fid").alias("FID"),
            F.coalesce("address", F.lit("")).alias("PrimaryEthAddress"),
        )
    )


def compact_links(live_links: DataFrame, span: int = 100_000) -> DataFrame:
    """Sorted targets per (Fid, LinkType), in pieces.

    Piece ``Part`` holds the targets in ``[Part * span, (Part + 1) * span)``, so
    an array never grows past ``span`` however many users one user follows.
    Pieces in order of ``Part`` make up the whole list.
    """
    return (
        live_links.withColumn("Part", F.floor(F.col("TargetFid") / span).cast("long"))
        .groupBy("Fid", "LinkType", "Part")
        .agg(F.array_sort(F.collect_set("TargetFid")).alias("TargetFids"))
    )


def newest_compacts(compacts: DataFrame) -> DataFrame:
    """The newest compact message of each user and link type; ties go to the highest hash.

    The newest are found without their lists, which move once.
    """
    newest = compacts.groupBy("Fid", "LinkType").agg(F.max(F.struct("Timestamp", "Hash")).alias("_newest"))
    newest = newest.select("Fid", "LinkType", "_newest.*")
    return compacts.join(newest, ["Fid", "LinkType", "Timestamp", "Hash"], "left_semi").dropDuplicates(
        ["Fid", "LinkType", "Timestamp", "Hash"]
    )


def compacted_log(log: DataFrame, compacts: DataFrame) -> DataFrame:
    """The log of links once compact messages have replaced what they stand for.

    A compact message at second t replaces all adds and removes of its user and link
    type up to t, that second included: its targets are adds at t, what comes later is
    applied on top. Each message is compared with one narrow row of its key; no
    list is held against a message.
    """
    newest = newest_compacts(compacts)
    since = newest.select("Fid", "LinkType", F.col("Timestamp").alias("_since"))
    later = (
        log.filter(F.col("MessageType").isin("LinkAdd", "LinkRemove"))
        .join(since, ["Fid", "LinkType"], "left")
        .filter(F.col("_since").isNull() | (F.col("Timestamp") > F.col("_since")))
        .select(*log.columns)
    )
    targets = F.array_distinct(codec.parse_mentions(F.col("TargetFids")))
    listed = newest.withColumn("TargetFid", F.explode(targets))
    blank = {f.name: F.lit(0 if f.dataType.typeName() == "long" else "") for f in log.schema.fields}
    given = {name: F.col(name) for name in listed.columns if name in blank}
    adds = listed.select(
        *[
            (F.lit("LinkAdd") if f.name == "MessageType" else given.get(f.name, blank[f.name]))
            .cast(f.dataType)
            .alias(f.name)
            for f in log.schema.fields
        ]
    )
    return later.unionByName(adds)


def live_compacted_links(log: DataFrame, compacts: DataFrame, how=live) -> DataFrame:
    """Current links of a log with compact messages."""
    return live_links(compacted_log(log, compacts), how)
