"""Verification and compact link messages, and messages under protobuf's names."""

from __future__ import annotations

from pyspark.sql import functions as F

from socialog.operators import lookup, normalize, state
from socialog.plans import fixtures as fx
from socialog.plans.catalog import query
from socialog.sources import schemas, tables

FID = 3


def verification_log(spark, sf):
    return normalize.flatten(fx.messages(spark, sf, "verifications"), "verifications")


def live_addresses(spark, sf):
    return state.listed_addresses(state.live_verifications(verification_log(spark, sf)))


@query("flat_verifications", "SELECT * FROM verification_log", ("verification_log",))
def _(spark, sf):
    return verification_log(spark, sf)


@query("live_verifications", "SELECT * FROM live_verifications", ("live_verifications",))
def _(spark, sf):
    return state.live_verifications(verification_log(spark, sf))


@query("latest_addresses_of_messages", "SELECT fid, address FROM live_addresses", ("live_addresses",))
def _(spark, sf):
    return state.latest_addresses(live_addresses(spark, sf))


@query(
    "pro_members_of_messages",
    """SELECT p.fid AS FID, coalesce(a.address, '') AS PrimaryEthAddress
       FROM active_pro p LEFT JOIN live_addresses a ON a.fid = p.fid""",
    ("active_pro", "live_addresses"),
)
def _(spark, sf):
    return state.pro_members(fx.tiers(spark, sf), live_addresses(spark, sf), fx.NOW)


@query(
    "verification_messages_of_fid",
    f"""SELECT Fid AS fid, MessageType AS type, Timestamp AS timestamp, Address AS address, Protocol AS protocol
        FROM live_verifications WHERE Fid = (SELECT min(Fid) FROM verification_log WHERE Fid > {FID})""",
    ("live_verifications",),
)
def _(spark, sf):
    fid = fx.table(spark, sf, "orders").filter(F.col("o_custkey") > FID).agg(F.min("o_custkey")).first()[0]
    return lookup.verifications(live_addresses(spark, sf), fid).drop("seq")


@query(
    "address_roles_of_messages",
    """SELECT fid, address, bool_or(c) AS is_custody, bool_or(a) AS is_auth, bool_or(v) AS is_verified
       FROM (SELECT c_custkey AS fid, '0x' || md5('a:' || c_custkey) AS address,
                    true AS c, false AS a, false AS v FROM customer
             UNION ALL
             SELECT c_custkey, '0x' || md5('b:' || c_custkey), false, true, false FROM customer
             UNION ALL
             SELECT Fid, Address, false, false, true FROM live_verifications)
       GROUP BY fid, address""",
    ("live_verifications",),
)
def _(spark, sf):
    return lookup.address_roles(fx.custody(spark, sf), live_addresses(spark, sf))


@query("live_compacted_links", "SELECT * FROM live_compacted_links", ("live_compacted_links",))
def _(spark, sf):
    compacts = normalize.flatten(fx.messages(spark, sf, "link_states"), "link_states")
    return state.live_compacted_links(fx.links(spark, sf), compacts)


@query(
    "compact_link_pieces",
    """SELECT Fid, LinkType, TargetFid // 4 AS Part, count(DISTINCT TargetFid) AS n,
              string_agg(DISTINCT TargetFid, ',' ORDER BY TargetFid) AS targets
       FROM live_compacted_links GROUP BY ALL""",
    ("live_compacted_links",),
)
def _(spark, sf):
    """Read back from compact messages and compacted again, in pieces of four ids."""
    compacts = normalize.flatten(fx.messages(spark, sf, "link_states"), "link_states")
    pieces = state.compact_links(state.live_compacted_links(fx.links(spark, sf), compacts), span=4)
    return pieces.select(
        "Fid", "LinkType", "Part",
        F.size("TargetFids").cast("long").alias("n"), F.array_join("TargetFids", ",").alias("targets"),
    )


def _as_protobuf_names(messages):
    """The messages as protobuf decodes them: enum names in full and in capitals, small numbers."""

    def full(prefix, name):
        return F.concat(F.lit(f"{prefix}_"), F.upper(F.regexp_replace(name, "(?<=[a-z])(?=[A-Z])", "_")))

    data = F.col("data")
    body = data["cast_add_body"].withField("embeds_deprecated", F.array(F.lit("unused")))
    return messages.select(
        F.struct(
            full("MESSAGE_TYPE", data["type"]).alias("type"),
            data["fid"].alias("fid"),
            data["timestamp"].cast("int").alias("timestamp"),
            full("SOCIAL_NETWORK", data["network"]).alias("network"),
            F.when(data["cast_add_body"].isNotNull(), body).alias("cast_add_body"),
            data["cast_remove_body"].alias("cast_remove_body"),
        ).alias("data"),
        "hash",
        full("HASH_SCHEME", F.col("hash_scheme")).alias("hash_scheme"),
        full("SIGNATURE_SCHEME", F.col("signature_scheme")).alias("signature_scheme"),
        F.lit(None).cast("binary").alias("data_bytes"),
    )


@query("decoded_casts", "SELECT * FROM casts", ("casts",))
def _(spark, sf):
    decoded = tables.decoded_messages(_as_protobuf_names(fx.messages(spark, sf, "casts")))
    kinds = schemas.MESSAGE_TYPES["casts"]
    return normalize.flatten(decoded.filter(F.col("data.type").isin(*kinds)), "casts")
