"""The log tables, derived from the given test tables.

``derive_*`` are Spark views over the given tables; ``fixture_sql`` states the
same views in SQL for the oracle. The log tables are stored once per session
below the shared folder, in files of one crawler batch, and scanned from there,
as they would be on a cluster.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from socialog.functions import clock, codec, labels
from socialog.session import new_path
from socialog.sources import schemas

FIRST_CAST = 94_608_000  # protocol second of 2024-01-01
NOW = 1_704_067_200  # Unix second of 2024-01-01, "now" of the tier test
FIELDS = ("Username", "Display", "Location", "Pfp", "Bio", "Twitter", "Url")
ALLOWED_FIDS = (1, 2, 3, 5, 8)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def digest(*parts: Column | str) -> Column:
    """``0x`` and the md5 of the joined parts."""
    columns = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.concat(F.lit("0x"), F.md5(F.concat(*columns)))


def base_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        clock.unix_of_wall_clock(F.col("ts")).alias("sec"),
        k.alias("k"),
        (k % 20).alias("c"),
    )


def _flat(df: DataFrame, kind: str, values: dict[str, Column]) -> DataFrame:
    signed = {"SignatureScheme": F.lit("Ed25519"), "Signature": F.lit(""), "Signer": F.lit("")}
    return df.select(*schemas.build(schemas.FLAT[kind], {**signed, **values}))


def derive_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = base_events(spark, sf_dir).filter(F.col("event_type").isin("purchase", "error"))
    sec = F.col("sec")
    return _flat(
        ev,
        "links",
        {
            "Fid": F.col("user_id"),
            "MessageType": F.when(F.col("event_type") == "purchase", "LinkAdd").otherwise("LinkRemove"),
            "Timestamp": sec - sec % 3600 - clock.EPOCH,
            "Hash": digest("l:", F.col("event_id")),
            "LinkType": F.lit("follow"),
            "TargetFid": F.col("k") % 10,
            "DisplayTimestamp": F.lit(0),
        },
    )


def derive_reactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = base_events(spark, sf_dir).filter(F.col("event_type").isin("click", "view", "error"))
    k, c = F.col("k"), F.col("c")
    to_url = k % 9 == 0
    target = F.concat((c % 15).cast("string"), F.lit(":"), digest("c:", c, ":0"))
    return _flat(
        ev,
        "reactions",
        {
            "Fid": F.col("user_id"),
            "MessageType": F.when(F.col("event_type") == "error", "ReactionRemove").otherwise("ReactionAdd"),
            "Timestamp": F.col("sec") - clock.EPOCH,
            "Hash": digest("x:", F.col("event_id")),
            "ReactionType": F.when(k % 2 == 0, "Like").otherwise("Recast"),
            "TargetCastId": F.when(to_url, "").otherwise(target),
            "TargetUrl": F.when(to_url, F.concat(F.lit("https://example.com/"), k.cast("string"))).otherwise(""),
        },
    )


def derive_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = base_events(spark, sf_dir).filter(F.col("event_type") == "signup")
    k = F.col("k")
    kind = F.element_at(F.array(*[F.lit(f) for f in FIELDS]), (k % 7 + 1).cast("int"))
    return _flat(
        ev,
        "profiles",
        {
            "Fid": F.col("user_id"),
            "MessageType": F.lit("UserDataAdd"),
            "Timestamp": F.col("sec") - clock.EPOCH,
            "Hash": digest("u:", F.col("event_id")),
            "UserDataType": kind,
            "Value": F.concat(F.lit("v"), F.lpad(k.cast("string"), 3, "0")),
            "UserDataTypeReadable": labels.field_label(kind),
        },
    )


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns with the page each refers to; all pages are referred to in turn."""
    pages = table(spark, sf_dir, "pages")
    urls = pages.groupBy(F.col("page_id").alias("_page")).agg(F.min("url").alias("url"))
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "text", (F.col("conv_id") % max(pages.count(), 1)).alias("_page")
    )
    return turns.join(urls, "_page", "left").select("conv_id", "turn", "text", "url")


def _cast_hash(turn: Column) -> Column:
    return digest("c:", F.col("conv_id"), ":", turn)


def derive_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv, turn, url = F.col("conv_id"), F.col("turn"), F.col("url")
    fid, parent_fid = (conv + turn) % 15, (conv + turn - 1) % 15
    at = F.lit(FIRST_CAST) + conv * 3600 + turn * 60
    parent = _cast_hash(turn - 1)
    url_embed = F.format_string(codec.URL_EMBED, url)
    cast_embed = F.format_string(codec.CAST_EMBED, parent_fid.cast("string"), parent)
    embeds = (
        F.when(turn % 4 == 1, url_embed)
        .when(turn % 4 == 2, cast_embed)
        .when(turn % 4 == 3, F.concat(url_embed, F.lit("|"), cast_embed))
        .otherwise("")
    )
    mentions = F.concat_ws(",", conv % 15, (conv + 2) % 15)
    blank = dict.fromkeys(
        ("Text", "Mentions", "ParentCastId", "ParentUrl", "Embeds", "TargetHash"), F.lit("")
    )
    turns = _turns(spark, sf_dir)
    added = _flat(
        turns,
        "casts",
        {
            **blank,
            "Fid": fid,
            "MessageType": F.lit("CastAdd"),
            "Timestamp": at,
            "Hash": _cast_hash(turn),
            "Text": F.col("text"),
            "Mentions": F.when(turn % 3 == 0, mentions).otherwise(""),
            "ParentCastId": F.when(turn > 0, F.concat_ws(":", parent_fid, parent)).otherwise(""),
            "ParentUrl": F.when((turn == 0) & (conv % 2 == 0), url).otherwise(""),
            "Embeds": embeds,
        },
    )
    removed = _flat(
        table(spark, sf_dir, "conversations").filter((conv + turn) % 7 == 0),
        "casts",
        {
            **blank,
            "Fid": fid,
            "MessageType": F.lit("CastRemove"),
            "Timestamp": at + 30,
            "Hash": digest("r:", conv, ":", turn),
            "TargetHash": _cast_hash(turn),
        },
    )
    return added.unionByName(removed)


def _cast_ref(fid: Column, digest_text: Column) -> Column:
    return F.struct(fid.alias("fid"), codec.from_hex(digest_text).alias("hash"))


def _split_ref(text: Column) -> Column:
    parsed = codec.parse_cast_id(text)
    return F.when(parsed.isNotNull(), _cast_ref(parsed["fid"], parsed["hash"]))


def _message(flat: DataFrame, bodies: dict[str, Column]) -> DataFrame:
    data = F.struct(
        F.col("MessageType").alias("type"),
        F.col("Fid").alias("fid"),
        F.col("Timestamp").alias("timestamp"),
        F.lit("Mainnet").alias("network"),
        *[
            bodies.get(name, F.lit(None)).cast(kind).alias(name)
            for name, kind in schemas.BODIES.items()
        ],
    )
    return flat.select(
        *schemas.build(
            schemas.MESSAGE,
            {
                "data": data,
                "hash": codec.from_hex(F.col("Hash")),
                "hash_scheme": F.lit("Blake3"),
                "signature_scheme": F.col("SignatureScheme"),
            },
        )
    )


def derive_cast_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = casts(spark, sf_dir)
    embeds = F.transform(
        codec.parse_embeds(F.col("Embeds")),
        lambda e: F.struct(
            e["url"].alias("url"),
            F.when(
                e["castId"].isNotNull(), _cast_ref(e["castId"]["fid"], e["castId"]["hash"])
            ).alias("cast_id"),
        ),
    )
    add = F.struct(
        F.col("Text").alias("text"),
        codec.parse_mentions(F.col("Mentions")).alias("mentions"),
        F.lit(None).cast("array<bigint>").alias("mentions_positions"),
        _split_ref(F.col("ParentCastId")).alias("parent_cast_id"),
        codec.or_null(F.col("ParentUrl")).alias("parent_url"),
        embeds.alias("embeds"),
    )
    remove = F.struct(codec.from_hex(F.col("TargetHash")).alias("target_hash"))
    is_add = F.col("MessageType") == "CastAdd"
    return _message(
        flat, {"cast_add_body": F.when(is_add, add), "cast_remove_body": F.when(~is_add, remove)}
    )


def derive_reaction_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.struct(
        F.col("ReactionType").alias("type"),
        _split_ref(F.col("TargetCastId")).alias("target_cast_id"),
        codec.or_null(F.col("TargetUrl")).alias("target_url"),
    )
    return _message(reactions(spark, sf_dir), {"reaction_body": body})


def derive_link_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.struct(
        F.col("LinkType").alias("type"),
        F.col("TargetFid").alias("target_fid"),
        F.lit(None).cast("bigint").alias("displayTimestamp"),
    )
    return _message(links(spark, sf_dir), {"link_body": body})


def derive_profile_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.struct(F.col("UserDataType").alias("type"), F.col("Value").alias("value"))
    return _message(profiles(spark, sf_dir), {"user_data_body": body})


def derive_link_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compact messages on the hour, so that some share their second with adds and removes."""
    ev = base_events(spark, sf_dir).filter(F.col("event_type") == "signup")
    sec, k = F.col("sec"), F.col("k")
    return _flat(
        ev,
        "link_states",
        {
            "Fid": F.col("user_id"),
            "MessageType": F.lit("LinkCompactState"),
            "Timestamp": sec - sec % 3600 - clock.EPOCH,
            "Hash": digest("k:", F.col("event_id")),
            "LinkType": F.lit("follow"),
            "TargetFids": F.concat_ws(",", k % 10, (k + 3) % 10, (k + 7) % 10),
        },
    )


def derive_link_state_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.struct(F.col("LinkType").alias("type"), codec.parse_mentions(F.col("TargetFids")).alias("target_fids"))
    return _message(link_states(spark, sf_dir), {"link_compact_state_body": body})


def derive_verification_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order verifies an address; a fifth of them are removed a day later."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    address = codec.from_hex(digest("a:", key))
    protocol = F.when(F.col("o_orderstatus") != "P", "Ethereum").otherwise("Solana")
    body = F.struct(address.alias("address"), protocol.alias("protocol"))
    at = clock.unix_of_wall_clock(F.col("o_orderdate")) - clock.unix_of_wall_clock(F.lit("1990-01-01").cast("timestamp"))
    flat = orders.select(
        "*",
        F.col("o_custkey").alias("Fid"),
        F.lit("Ed25519").alias("SignatureScheme"),
        F.explode(F.when(key % 5 == 0, F.array(F.lit("add"), F.lit("gone"))).otherwise(F.array(F.lit("add")))).alias("kind"),
    ).withColumns(
        {
            "Timestamp": at + F.when(F.col("kind") == "gone", 86_400).otherwise(0),
            "Hash": digest(F.col("kind"), ":", key),
            "MessageType": F.when(F.col("kind") == "add", "VerificationAddEthAddress").otherwise("VerificationRemove"),
        }
    )
    added = F.col("kind") == "add"
    return _message(
        flat, {"verification_add_address_body": F.when(added, body), "verification_remove_body": F.when(~added, body)}
    )


def derive_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event stream: merges of casts and links, prunes without a body."""
    ev = base_events(spark, sf_dir)
    k, c, eid, user = F.col("k"), F.col("c"), F.col("event_id"), F.col("user_id")
    kind = F.col("event_type")
    is_add = kind.isin("click", "view")
    data_type = schemas.MESSAGE["data"].dataType
    add = F.struct(
        F.concat(F.lit("event "), eid.cast("string")).alias("text"),
        F.when(k % 3 == 0, F.array(k % 15, (k + 2) % 15)).alias("mentions"),
        F.lit(None).cast("array<bigint>").alias("mentions_positions"),
        F.when(k % 4 == 1, _cast_ref(c % 15, digest("c:", c, ":0"))).alias("parent_cast_id"),
        F.lit(None).cast("string").alias("parent_url"),
        F.when(
            k % 5 == 0,
            F.array(
                F.struct(
                    F.concat(F.lit("https://example.com/"), k.cast("string")).alias("url"),
                    F.lit(None).cast("struct<fid: bigint, hash: binary>").alias("cast_id"),
                )
            ),
        ).alias("embeds"),
    )
    bodies = {
        "cast_add_body": F.when(is_add, add),
        "cast_remove_body": F.when(
            kind == "error", F.struct(codec.from_hex(digest("e:", eid - 1)).alias("target_hash"))
        ),
        "link_body": F.when(
            kind == "purchase",
            F.struct(
                F.lit("follow").alias("type"),
                (k % 10).alias("target_fid"),
                F.lit(None).cast("bigint").alias("displayTimestamp"),
            ),
        ),
    }
    at = F.col("sec") - clock.EPOCH
    data = F.struct(
        *schemas.build(
            data_type,
            {
                "type": F.when(is_add, "CastAdd").when(kind == "error", "CastRemove").otherwise("LinkAdd"),
                "fid": user,
                "timestamp": at,
                "network": F.lit("Mainnet"),
                **bodies,
            },
        )
    )
    message = F.struct(
        *schemas.build(
            schemas.MESSAGE,
            {
                "data": data,
                "hash": codec.from_hex(digest("e:", eid)),
                "hash_scheme": F.lit("Blake3"),
                "signature_scheme": F.lit("Ed25519"),
            },
        )
    )
    pruned = kind == "signup"
    return ev.select(
        *schemas.build(
            schemas.EVENT,
            {
                "id": eid,
                "type": F.when(pruned, "PRUNE_MESSAGE").otherwise("MERGE_MESSAGE"),
                "timestamp": at,
                "shard_index": user % 3,
                "merge_message_body": F.when(~pruned, F.struct(message.alias("message"))),
                "processed_at": (F.col("sec") + k) * 1000,
            },
        )
    )


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("Fid"), (F.col("user_id") % 3).alias("shard")
    )


def tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    tier = F.struct(
        F.lit("Pro").alias("tier_type"),
        F.when(F.col("c_nationkey") < 12, 1735689600).otherwise(1672531200).cast("long").alias("expires_at"),
    )
    none = F.array().cast("array<struct<tier_type: string, expires_at: bigint>>")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("fid"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.array(tier))
        .otherwise(none)
        .alias("tier_subscriptions"),
    )


def verifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("fid"),
        F.lit("VerificationAddEthAddress").alias("type"),
        clock.unix_of_wall_clock(F.col("o_orderdate")).alias("timestamp"),
        digest("a:", F.col("o_orderkey")).alias("address"),
        F.when(F.col("o_orderstatus") != "P", "Ethereum").otherwise("Solana").alias("protocol"),
        F.col("o_orderkey").alias("seq"),
    )


def custody(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("fid"),
        digest("a:", F.col("c_custkey")).alias("custody_address"),
        digest("b:", F.col("c_custkey")).alias("auth_address"),
    )


def derive_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = F.col("event_type") != "error"
    return base_events(spark, sf_dir).select(
        "event_id",
        F.col("event_type").alias("context"),
        ok.alias("ok"),
        F.when(~ok, F.concat(F.lit("code"), (F.col("k") % 4).cast("string"))).alias("error_type"),
        (F.col("k") % 4).alias("retries"),
        F.col("value").alias("latency_ms"),
        F.col("sec").alias("called_at"),
        "k",
    )


def batch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        calls(spark, sf_dir)
        .groupBy(F.floor(F.col("event_id") / 100).alias("batch_no"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("k").alias("bytes"),
            F.max("k").alias("flush_ms"),
        )
    )


def sweep_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages and reading time of each user."""
    return (
        base_events(spark, sf_dir)
        .groupBy(F.col("user_id").alias("Fid"))
        .agg(F.count(F.lit(1)).alias("messages"), F.sum("k").alias("elapsed_ms"))
    )


BATCH_ROWS = 25_000
_STORED: dict[tuple[str, str, str], tuple[str, T.StructType]] = {}


def stored(derive):
    """``derive``, written on first use in a session and scanned ever after."""

    def scan(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir, derive.__name__)
        if key in _STORED:
            path, schema = _STORED[key]
            try:
                return spark.read.schema(schema).parquet(path)
            except AnalysisException:  # the shared folder was emptied
                del _STORED[key]
        df, path = derive(spark, sf_dir), new_path(spark, derive.__name__)
        df.write.option("maxRecordsPerFile", BATCH_ROWS).parquet(path)
        _STORED[key] = path, df.schema
        return spark.read.schema(df.schema).parquet(path)

    return scan


links = stored(derive_links)
reactions = stored(derive_reactions)
profiles = stored(derive_profiles)
casts = stored(derive_casts)
cast_messages = stored(derive_cast_messages)
reaction_messages = stored(derive_reaction_messages)
link_messages = stored(derive_link_messages)
profile_messages = stored(derive_profile_messages)
link_states = stored(derive_link_states)
link_state_messages = stored(derive_link_state_messages)
verification_messages = stored(derive_verification_messages)
events = stored(derive_events)
calls = stored(derive_calls)

FLAT = {"casts": casts, "reactions": reactions, "links": links, "profiles": profiles}
MESSAGES = {
    "casts": cast_messages,
    "reactions": reaction_messages,
    "links": link_messages,
    "profiles": profile_messages,
    "link_states": link_state_messages,
    "verifications": verification_messages,
}


def messages(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return MESSAGES[kind](spark, sf_dir)
