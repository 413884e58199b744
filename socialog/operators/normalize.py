"""Nested messages to flat rows, typed views and normalised casts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from socialog.functions import clock, codec, labels
from socialog.functions.codec import or_blank, or_null, or_zero

DATA = "data"


def common_columns() -> list[Column]:
    """The seven columns every flat table starts with."""
    data = F.col(DATA)
    return [
        or_zero(data["fid"]).alias("Fid"),
        F.coalesce(data["type"], F.lit("Unknown")).alias("MessageType"),
        or_zero(data["timestamp"]).alias("Timestamp"),
        codec.hex_text(F.col("hash")).alias("Hash"),
        F.coalesce("signature_scheme", F.lit("None")).alias("SignatureScheme"),
        codec.hex_text(F.col("signature")).alias("Signature"),
        codec.hex_text(F.col("signer")).alias("Signer"),
    ]


def flatten_common(messages: DataFrame) -> DataFrame:
    return messages.select(*common_columns())


def flatten_casts(messages: DataFrame) -> DataFrame:
    add = F.col(DATA)["cast_add_body"]
    return messages.select(
        *common_columns(),
        or_blank(add["text"]).alias("Text"),
        codec.mentions_text(add["mentions"]).alias("Mentions"),
        codec.cast_id_text(add["parent_cast_id"]).alias("ParentCastId"),
        or_blank(add["parent_url"]).alias("ParentUrl"),
        codec.embeds_text(add["embeds"]).alias("Embeds"),
        codec.hex_text(F.col(DATA)["cast_remove_body"]["target_hash"]).alias("TargetHash"),
    )


def flatten_reactions(messages: DataFrame) -> DataFrame:
    body = F.col(DATA)["reaction_body"]
    return messages.select(
        *common_columns(),
        or_blank(body["type"]).alias("ReactionType"),
        codec.cast_id_text(body["target_cast_id"]).alias("TargetCastId"),
        or_blank(body["target_url"]).alias("TargetUrl"),
    )


def flatten_links(messages: DataFrame) -> DataFrame:
    body = F.col(DATA)["link_body"]
    return messages.select(
        *common_columns(),
        or_blank(body["type"]).alias("LinkType"),
        or_zero(body["target_fid"]).alias("TargetFid"),
        or_zero(body["displayTimestamp"]).alias("DisplayTimestamp"),
    )


def flatten_profiles(messages: DataFrame) -> DataFrame:
    body = F.col(DATA)["user_data_body"]
    return messages.select(
        *common_columns(),
        or_blank(body["type"]).alias("UserDataType"),
        or_blank(body["value"]).alias("Value"),
        F.when(body.isNotNull(), labels.field_label(body["type"])).otherwise("").alias(
            "UserDataTypeReadable"
        ),
    )


def flatten_verifications(messages: DataFrame) -> DataFrame:
    """Address and protocol of added and removed verifications."""
    data = F.col(DATA)
    add, gone = data["verification_add_address_body"], data["verification_remove_body"]
    return messages.select(
        *common_columns(),
        codec.hex_text(F.coalesce(add["address"], gone["address"])).alias("Address"),
        or_blank(F.coalesce(add["protocol"], gone["protocol"])).alias("Protocol"),
    )


def flatten_link_states(messages: DataFrame) -> DataFrame:
    """Compact link messages: the whole list of targets of a user and link type, as text like mentions."""
    body = F.col(DATA)["link_compact_state_body"]
    return messages.select(
        *common_columns(),
        or_blank(body["type"]).alias("LinkType"),
        codec.mentions_text(body["target_fids"]).alias("TargetFids"),
    )


FLATTEN = {
    "casts": flatten_casts,
    "reactions": flatten_reactions,
    "links": flatten_links,
    "profiles": flatten_profiles,
    "verifications": flatten_verifications,
    "link_states": flatten_link_states,
}


def flatten(messages: DataFrame, kind: str, converter=None) -> DataFrame:
    """Flat table of one kind.

    ``converter`` is the caller's own ``DataFrame -> DataFrame`` function in
    place of the built-in one.
    """
    return messages.transform(converter or FLATTEN[kind])


def typed_casts(casts: DataFrame) -> DataFrame:
    """Flat casts with arrays, structs and timestamps; blanks become NULL."""
    return casts.select(
        "Fid",
        "MessageType",
        clock.to_timestamp(F.col("Timestamp")).alias("CreatedAt"),
        "Timestamp",
        "Hash",
        "Text",
        codec.parse_mentions(F.col("Mentions")).alias("Mentions"),
        codec.parse_cast_id(F.col("ParentCastId")).alias("Parent"),
        or_null(F.col("ParentUrl")).alias("ParentUrl"),
        codec.parse_embeds(F.col("Embeds")).alias("Embeds"),
        or_null(F.col("TargetHash")).alias("TargetHash"),
    )


def body_rows(messages: DataFrame) -> DataFrame:
    """Alternate flat row: snake_case names, binary ids, body fields or NULL."""
    data = F.col(DATA)
    add, remove, user = (
        data["cast_add_body"], data["cast_remove_body"], data["user_data_body"],
    )
    parent = add["parent_cast_id"]
    mentioned = F.size(add["mentions"]) > 0
    empty = F.lit(b"")
    return messages.select(
        F.coalesce("hash", empty).alias("hash"),
        "hash_scheme",
        F.coalesce("signature", empty).alias("signature"),
        "signature_scheme",
        F.coalesce("signer", empty).alias("signer"),
        data["type"].alias("data_type"),
        data["fid"].alias("data_fid"),
        data["timestamp"].alias("data_timestamp"),
        data["network"].alias("data_network"),
        F.when(add.isNotNull(), "CastAddBody")
        .when(remove.isNotNull(), "CastRemoveBody")
        .when(user.isNotNull(), "UserDataBody")
        .alias("body_type"),
        F.when(add.isNotNull(), or_blank(add["text"])).alias("cast_text"),
        parent["fid"].alias("parent_cast_fid"),
        F.when(parent.isNotNull(), F.coalesce(parent["hash"], empty)).alias("parent_cast_hash"),
        F.when(mentioned, F.size(add["mentions"])).alias("mentions_count"),
        F.when(mentioned, codec.mentions_text(add["mentions"])).alias("mentions"),
        F.when(remove.isNotNull(), F.coalesce(remove["target_hash"], empty)).alias("target_hash"),
        user["type"].alias("user_data_type"),
        user["value"].alias("user_data_value"),
    )


def normalize_events(events: DataFrame) -> DataFrame:
    """Normalised cast of each event that carries message data.

    Every kind other than CastAdd is labelled ``cast_remove``. Absent parts are
    NULL, so ``to_json`` leaves them out.
    """
    message = F.col("merge_message_body")["message"]
    data = message["data"]
    is_add = data["type"] == "CastAdd"
    add = F.when(is_add, data["cast_add_body"])
    parent = add["parent_cast_id"]

    def embed(e: Column) -> Column:
        cast_id = e["cast_id"]
        return F.struct(
            or_blank(e["url"]).alias("url"),
            F.when(
                cast_id.isNotNull(),
                F.struct(
                    or_zero(cast_id["fid"]).alias("fid"),
                    codec.plain_hex(cast_id["hash"]).alias("hash"),
                ),
            ).alias("cast_id"),
        )

    def unless_empty(array: Column, value: Column | None = None) -> Column:
        return F.when(F.size(array) > 0, array if value is None else value)

    return events.filter(data.isNotNull()).select(
        or_zero(data["fid"]).alias("fid"),
        codec.plain_hex(message["hash"]).alias("hash"),
        or_zero(data["timestamp"]).alias("timestamp"),
        F.when(add.isNotNull(), or_blank(add["text"])).alias("text"),
        unless_empty(add["embeds"], F.transform(add["embeds"], embed)).alias("embeds"),
        unless_empty(add["mentions"]).alias("mentions"),
        unless_empty(add["mentions_positions"]).alias("mentions_positions"),
        F.when(parent.isNotNull(), codec.plain_hex(parent["hash"])).alias("parent_hash"),
        F.when(parent.isNull(), or_null(add["parent_url"])).alias("parent_url"),
        F.col("id").alias("event_id"),
        F.when(is_add, "cast_add").otherwise("cast_remove").alias("message_type"),
        F.when(
            (data["type"] == "CastRemove") & data["cast_remove_body"].isNotNull(),
            codec.plain_hex(data["cast_remove_body"]["target_hash"]),
        ).alias("target_hash"),
        F.col("timestamp").alias("event_timestamp"),
        F.col("processed_at"),
    )


def profile_card(profiles: DataFrame, fid: int) -> DataFrame:
    """``label: value`` lines of one user."""
    return profiles.filter(F.col("Fid") == fid).select(
        "Fid",
        "Timestamp",
        "Hash",
        F.concat_ws(": ", labels.field_label(F.col("UserDataType")), "Value").alias("Line"),
    )


def keep_parsable(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add ``value`` as ``name`` and mark rows where it could not be made.

    Pass a ``try_*`` expression: a bad row is marked ``failed`` and does not end
    the job; ``count_if(failed)`` counts them.
    """
    return df.withColumn(name, value).withColumn("failed", F.col(name).isNull())
