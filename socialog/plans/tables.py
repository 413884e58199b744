"""Scans, sinks, projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from socialog.functions import clock, codec, labels
from socialog.operators import analytics, filters, normalize, ordering, state
from socialog.plans import fixtures as fx
from socialog.plans import jobs
from socialog.plans.catalog import query
from socialog.session import new_path
from socialog.sources import schemas, sinks, tables

NOW = 1_705_968_000  # Unix second of 2024-01-23, "now" of the time filters
LATER = 1_735_689_600  # 2025-01-01, after all test rows
FLAT_SQL = {kind: f"SELECT * FROM {kind}" for kind in fx.FLAT}

# ---- scans and sinks -------------------------------------------------------


@query("scan_cast_log", FLAT_SQL["casts"], ("casts",))
def _(spark, sf):
    folder = new_path(spark, "casts")
    fx.casts(spark, sf).write.parquet(folder)
    return tables.scan_log(spark, folder, "casts")


@query("scan_nested_messages", FLAT_SQL["links"], ("links",))
def _(spark, sf):
    folder = new_path(spark, "messages")
    fx.link_messages(spark, sf).write.parquet(folder)
    return normalize.flatten_links(tables.scan_messages(spark, folder))


@query("scan_json_messages", FLAT_SQL["reactions"], ("reactions",))
def _(spark, sf):
    folder = new_path(spark, "messages")
    fx.reaction_messages(spark, sf).write.json(folder)
    return normalize.flatten_reactions(tables.scan_messages(spark, folder, "json"))


@query(
    "table_by_kind",
    " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, MessageType, count(*) AS n FROM {kind} GROUP BY MessageType"
        for kind in fx.FLAT
    ),
    tuple(fx.FLAT),
)
def _(spark, sf):
    root = new_path(spark, "log")
    counts = []
    for kind, build in fx.FLAT.items():
        build(spark, sf).write.parquet(f"{root}/{kind}/{kind}_messages")
        log = tables.scan_kind(spark, root, kind)
        counts.append(
            log.groupBy("MessageType")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(kind).alias("kind"), "MessageType", "n")
        )
    return tables.union_shards(*counts)


_EVENT_COLUMNS = ("id", "type", "timestamp", "shard_index", "processed_at")


@query(
    "event_range_forward",
    """SELECT id, type, timestamp, shard_index, processed_at FROM stream_events
       WHERE id BETWEEN 100 AND 900 ORDER BY id LIMIT 50""",
    ("stream_events",),
)
def _(spark, sf):
    return tables.event_range(fx.events(spark, sf), 100, 900, 50).select(*_EVENT_COLUMNS)


@query(
    "event_range_reverse",
    """SELECT id, type, timestamp, shard_index, processed_at FROM stream_events
       WHERE id >= 100 AND shard_index = 2 ORDER BY id DESC LIMIT 50""",
    ("stream_events",),
)
def _(spark, sf):
    return tables.event_range(fx.events(spark, sf), 100, size=50, reverse=True, shard=2).select(
        *_EVENT_COLUMNS
    )


@query("sweep_range", "SELECT * FROM links WHERE Fid BETWEEN 3 AND 10", ("links",))
def _(spark, sf):
    return tables.sweep(fx.links(spark, sf), 10, 3)


@query("export_live_casts", "SELECT * FROM live_casts", ("live_casts",))
def _(spark, sf):
    folder = new_path(spark, "export")
    sinks.export_zstd(state.live_casts(fx.casts(spark, sf)), folder)
    return spark.read.schema(schemas.CASTS).parquet(folder)


for _profile in sinks.PROFILES:

    @query(f"write_{_profile}", FLAT_SQL["reactions"], ("reactions",))
    def _(spark, sf, profile=_profile):
        folder = new_path(spark, profile)
        sinks.write_tuned(fx.reactions(spark, sf), folder, profile)
        return tables.scan_log(spark, folder, "reactions")


@query(
    "even_parts",
    "SELECT event_id, ntile(7) OVER (ORDER BY event_id) AS part FROM events",
)
def _(spark, sf):
    return ordering.even_parts(fx.table(spark, sf, "events").select("event_id"), 7, "event_id")


@query("write_even_parts", "SELECT Hash FROM links", ("links",))
def _(spark, sf):
    folder = new_path(spark, "parts")
    sinks.write_parts(fx.links(spark, sf), folder, 4)
    return tables.scan_log(spark, folder, "links").select("Hash")


@query(
    "numbered_batches",
    """SELECT MessageType, Hash, n // 500 + 1 AS batch_no,
              'batch_' || MessageType || '_' || (n // 500 + 1) AS batch_id
       FROM (SELECT MessageType, Hash,
                    row_number() OVER (PARTITION BY MessageType ORDER BY Timestamp, Hash) - 1 AS n
             FROM links)""",
    ("links",),
)
def _(spark, sf):
    rows = fx.links(spark, sf).select("MessageType", "Timestamp", "Hash")
    return ordering.batches(rows, ["MessageType"], 500, "Timestamp", "Hash").drop("Timestamp")


@query(
    "write_statistics",
    "SELECT count(*) AS rows, true AS all_measured FROM profiles",
    ("profiles",),
)
def _(spark, sf):
    folder = new_path(spark, "stats")
    sinks.write_tuned(fx.profiles(spark, sf), folder, "small")
    files = sinks.write_statistics(spark, folder)
    return files.agg(
        F.sum("rows").alias("rows"),
        F.bool_and((F.col("file_bytes") > 0) & (F.col("compression_ratio") > 0)).alias("all_measured"),
    )


@query(
    "sink_totals",
    """SELECT count(*) AS batches, CAST(sum(rows) AS BIGINT) AS rows,
              CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum(flush_ms) AS BIGINT) AS total_flush_ms,
              round(avg(flush_ms), 6) AS avg_flush_ms, max(flush_ms) AS peak_flush_ms
       FROM batch_log""",
    ("batch_log",),
)
def _(spark, sf):
    totals = sinks.sink_totals(fx.batch_log(spark, sf))
    return totals.withColumn("avg_flush_ms", F.round("avg_flush_ms", 6))


@query("clustered_log", "SELECT * FROM reactions WHERE Fid = 3", ("reactions",))
def _(spark, sf):
    folder = new_path(spark, "clustered")
    rows = sinks.clustered(fx.reactions(spark, sf), "Fid", "Timestamp")
    sinks.write_tuned(rows, folder, "high_throughput")
    return filters.of_fid(tables.scan_log(spark, folder, "reactions"), 3)


@query("compacted_log", FLAT_SQL["links"], ("links",))
def _(spark, sf):
    small, large = new_path(spark, "small"), new_path(spark, "compact")
    fx.links(spark, sf).repartition(12).write.parquet(small)
    sinks.compact(spark, small, large)
    return tables.scan_log(spark, large, "links")


_PRO_SQL = """SELECT p.fid AS FID, coalesce(a.address, '') AS PrimaryEthAddress
              FROM active_pro p LEFT JOIN latest_addresses a ON a.fid = p.fid"""


@query("csv_export", _PRO_SQL, ("active_pro", "latest_addresses"))
def _(spark, sf):
    folder = new_path(spark, "csv")
    members = state.pro_members(fx.tiers(spark, sf), fx.verifications(spark, sf), fx.NOW)
    sinks.write_csv(members, folder)
    read = spark.read.schema("FID bigint, PrimaryEthAddress string").option("header", "false")
    return read.csv(folder).withColumn(
        "PrimaryEthAddress", codec.or_blank(F.col("PrimaryEthAddress"))
    )


@query("messages_to_live_links", "SELECT * FROM live_links", ("live_links",))
def _(spark, sf):
    """Nested messages to flat log to exported state, each stored."""
    source, root, target = (new_path(spark, name) for name in ("messages", "log", "export"))
    for kind in ("links", "reactions"):
        fx.messages(spark, sf, kind).write.mode("append").parquet(source)
    jobs.write_log(spark, source, root, "links", LATER)
    jobs.export_state(spark, root, "links", target)
    return spark.read.schema(schemas.LINKS).parquet(target)


@query(
    "recent_messages_of_fid",
    f"""SELECT * FROM reactions WHERE Fid = 3 AND Timestamp + 1609459200 >= {NOW} - 7 * 86400
        AND Timestamp + 1609459200 <= {NOW} + 86400""",
    ("reactions",),
)
def _(spark, sf):
    source, root = new_path(spark, "messages"), new_path(spark, "log")
    for kind in ("links", "reactions"):
        fx.messages(spark, sf, kind).write.mode("append").parquet(source)
    jobs.write_log(spark, source, root, "reactions", NOW, fid=3, days=7)
    return tables.scan_kind(spark, root, "reactions")


# ---- projections -----------------------------------------------------------

_COMMON = "Fid, MessageType, Timestamp, Hash, SignatureScheme, Signature, Signer"


@query("common_columns", f"SELECT {_COMMON} FROM links", ("links",))
def _(spark, sf):
    return normalize.flatten_common(fx.link_messages(spark, sf))


for _kind in fx.FLAT:

    @query(f"flat_{_kind}", FLAT_SQL[_kind], (_kind,))
    def _(spark, sf, kind=_kind):
        return normalize.flatten(fx.messages(spark, sf, kind), kind)


@query(
    "field_labels",
    "SELECT UserDataType, UserDataTypeReadable AS label, count(*) AS n FROM profiles GROUP BY 1, 2",
    ("profiles",),
)
def _(spark, sf):
    return (
        fx.profiles(spark, sf)
        .groupBy("UserDataType")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("label", labels.field_label(F.col("UserDataType")))
    )


@query(
    "hex_texts",
    "SELECT Hash AS prefixed, substr(Hash, 3) AS plain, '' AS empty FROM casts",
    ("casts",),
)
def _(spark, sf):
    return fx.cast_messages(spark, sf).select(
        codec.hex_text(F.col("hash")).alias("prefixed"),
        codec.plain_hex(F.col("hash")).alias("plain"),
        codec.hex_text(F.col("signature")).alias("empty"),
    )


@query("cast_id_texts", "SELECT Hash, TargetCastId FROM reactions", ("reactions",))
def _(spark, sf):
    return fx.reaction_messages(spark, sf).select(
        codec.hex_text(F.col("hash")).alias("Hash"),
        codec.cast_id_text(F.col("data.reaction_body.target_cast_id")).alias("TargetCastId"),
    )


@query("mention_texts", "SELECT Hash, Mentions FROM casts", ("casts",))
def _(spark, sf):
    return fx.cast_messages(spark, sf).select(
        codec.hex_text(F.col("hash")).alias("Hash"),
        codec.mentions_text(F.col("data.cast_add_body.mentions")).alias("Mentions"),
    )


@query("embed_texts", "SELECT Hash, Embeds FROM casts", ("casts",))
def _(spark, sf):
    return fx.cast_messages(spark, sf).select(
        codec.hex_text(F.col("hash")).alias("Hash"),
        codec.embeds_text(F.col("data.cast_add_body.embeds")).alias("Embeds"),
    )


@query(
    "absent_bodies",
    f"""SELECT {_COMMON}, '' AS LinkType, CAST(0 AS BIGINT) AS TargetFid,
               CAST(0 AS BIGINT) AS DisplayTimestamp FROM reactions""",
    ("reactions",),
)
def _(spark, sf):
    return normalize.flatten_links(fx.reaction_messages(spark, sf))


@query(
    "typed_casts",
    """SELECT Hash, Timestamp + 1609459200 AS created_unix,
              CASE WHEN Mentions = '' THEN 0 ELSE len(string_split(Mentions, ',')) END AS n_mentions,
              CAST(nullif(split_part(Mentions, ',', 1), '') AS BIGINT) AS first_mention,
              CAST(nullif(split_part(ParentCastId, ':', 1), '') AS BIGINT) AS parent_fid,
              nullif(split_part(ParentCastId, ':', 2), '') AS parent_hash,
              nullif(ParentUrl, '') AS parent_url,
              CASE WHEN Embeds = '' THEN 0 WHEN contains(Embeds, '}|{') OR contains(Embeds, '} |{')
                   THEN 2 ELSE 1 END AS n_embeds,
              nullif(regexp_extract(Embeds, '"url": "([^"]*)"', 1), '') AS embed_urls,
              nullif(regexp_extract(Embeds, '"hash": "([^"]*)"', 1), '') AS embed_hashes,
              nullif(TargetHash, '') AS target_hash
       FROM casts""",
    ("casts",),
)
def _(spark, sf):
    typed = normalize.typed_casts(fx.casts(spark, sf))
    return typed.select(
        "Hash",
        F.unix_seconds("CreatedAt").alias("created_unix"),
        F.size("Mentions").cast("long").alias("n_mentions"),
        F.get("Mentions", F.lit(0)).alias("first_mention"),
        F.col("Parent.fid").alias("parent_fid"),
        F.col("Parent.hash").alias("parent_hash"),
        F.col("ParentUrl").alias("parent_url"),
        F.size("Embeds").alias("n_embeds"),
        codec.or_null(F.array_join("Embeds.url", ",")).alias("embed_urls"),
        codec.or_null(F.array_join("Embeds.castId.hash", ",")).alias("embed_hashes"),
        F.col("TargetHash").alias("target_hash"),
    )


NORMALIZED = """fid, hash, timestamp, text, mentions, parent_hash, parent_url, embed_urls,
                 event_id, message_type, target_hash, processed_at"""


def normalized_texts(casts):
    """Normalised casts with their arrays as text, and their queue if they have one."""
    return casts.select(
        *[c for c in casts.columns if c == "queue"],
        "fid",
        "hash",
        "timestamp",
        "text",
        F.array_join("mentions", ",").alias("mentions"),
        "parent_hash",
        "parent_url",
        F.array_join(F.transform("embeds", lambda e: e["url"]), ",").alias("embed_urls"),
        "event_id",
        "message_type",
        "target_hash",
        "processed_at",
    )


@query("normalized_casts", f"SELECT {NORMALIZED} FROM normalized", ("normalized",))
def _(spark, sf):
    merged = filters.merged_messages(fx.events(spark, sf))
    return normalized_texts(normalize.normalize_events(merged))


@query(
    "body_rows",
    """SELECT substr(Hash, 3) AS hash, 'Blake3' AS hash_scheme, MessageType AS data_type,
              Fid AS data_fid, Timestamp AS data_timestamp, 'Mainnet' AS data_network,
              MessageType || 'Body' AS body_type,
              CASE WHEN MessageType = 'CastAdd' THEN Text END AS cast_text,
              CAST(nullif(split_part(ParentCastId, ':', 1), '') AS BIGINT) AS parent_cast_fid,
              nullif(substr(split_part(ParentCastId, ':', 2), 3), '') AS parent_cast_hash,
              CAST(CASE WHEN Mentions <> '' THEN len(string_split(Mentions, ',')) END AS INTEGER)
                  AS mentions_count,
              nullif(Mentions, '') AS mentions, nullif(substr(TargetHash, 3), '') AS target_hash
       FROM casts""",
    ("casts",),
)
def _(spark, sf):
    rows = normalize.body_rows(fx.cast_messages(spark, sf))
    as_text = {c: F.lower(F.hex(c)) for c in ("hash", "parent_cast_hash", "target_hash")}
    return rows.withColumns(as_text).drop(
        "signature", "signature_scheme", "signer", "user_data_type", "user_data_value"
    )


@query(
    "user_body_rows",
    """SELECT substr(Hash, 3) AS hash, 'UserDataBody' AS body_type,
              UserDataType AS user_data_type, Value AS user_data_value FROM profiles""",
    ("profiles",),
)
def _(spark, sf):
    rows = normalize.body_rows(fx.profile_messages(spark, sf))
    return rows.select(
        F.lower(F.hex("hash")).alias("hash"), "body_type", "user_data_type", "user_data_value"
    )


@query(
    "protocol_times",
    """SELECT Hash, Timestamp + 1609459200 AS unix, (Timestamp + 1609459200) * 1000 AS millis,
              CAST(make_timestamp((Timestamp + 1609459200) * 1000000) AS DATE) AS day,
              strftime(make_timestamp((Timestamp + 1609459200) * 1000000), '%Y-%m') AS month,
              Timestamp AS back
       FROM casts""",
    ("casts",),
)
def _(spark, sf):
    at = F.col("Timestamp")
    return fx.casts(spark, sf).select(
        "Hash",
        clock.to_unix(at).alias("unix"),
        clock.to_millis(at).alias("millis"),
        clock.day_of(at).alias("day"),
        clock.month_text(clock.month_start(at)).alias("month"),
        clock.from_timestamp(clock.to_timestamp(at)).alias("back"),
    )


@query(
    "schema_from_sample",
    "SELECT event_id, user_id, event_type, value, props FROM events",
)
def _(spark, sf):
    rows = fx.table(spark, sf, "events").drop("ts")
    sample = rows.first().asDict()
    return schemas.conform(rows, schemas.schema_of_row(sample))


@query(
    "profile_cards",
    """SELECT Fid, Timestamp, Hash, UserDataTypeReadable || ': ' || Value AS Line
       FROM profiles WHERE Fid = 3""",
    ("profiles",),
)
def _(spark, sf):
    return normalize.profile_card(fx.profiles(spark, sf), 3)


# ---- filters ---------------------------------------------------------------


@query(
    "last_days",
    f"SELECT * FROM reactions WHERE Timestamp + 1609459200 >= {NOW} - 7 * 86400",
    ("reactions",),
)
def _(spark, sf):
    return filters.last_days(fx.reactions(spark, sf), 7, NOW)


@query(
    "not_future",
    f"SELECT * FROM reactions WHERE Timestamp <= {NOW} - 1609459200 + 86400",
    ("reactions",),
)
def _(spark, sf):
    return filters.not_future(fx.reactions(spark, sf), NOW)


@query(
    "time_filter_counts",
    f"""SELECT count(*) AS retrieved, count(*) FILTER (old) AS too_old,
               count(*) FILTER (NOT old AND future) AS in_future,
               count(*) FILTER (NOT old AND NOT future) AS kept
        FROM (SELECT Timestamp + 1609459200 < {NOW} - 7 * 86400 AS old,
                     Timestamp > {NOW} - 1609459200 + 86400 AS future FROM reactions)""",
    ("reactions",),
)
def _(spark, sf):
    return filters.time_filter_counts(fx.reactions(spark, sf), NOW, 7)


@query("of_fid", "SELECT * FROM casts WHERE Fid = 3", ("casts",))
def _(spark, sf):
    return filters.of_fid(fx.casts(spark, sf), 3)


@query("of_types", "SELECT * FROM links WHERE MessageType IN ('LinkAdd', 'LinkCompactState')", ("links",))
def _(spark, sf):
    return filters.of_types(fx.links(spark, sf), ("LinkAdd", "LinkCompactState"))


@query(
    "allowed_fids",
    f"SELECT * FROM reactions WHERE Fid IN {fx.ALLOWED_FIDS}",
    ("reactions",),
)
def _(spark, sf):
    return filters.of_fids(fx.reactions(spark, sf), fx.ALLOWED_FIDS)


@query(
    "allowed_fids_table",
    """SELECT * FROM reactions WHERE Fid IN
       (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
    ("reactions",),
)
def _(spark, sf):
    building = fx.table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'")
    return filters.of_fids(fx.reactions(spark, sf), building.select("c_custkey"))


@query(
    "merged_messages",
    "SELECT id, type, timestamp FROM stream_events WHERE message_kind IS NOT NULL",
    ("stream_events",),
)
def _(spark, sf):
    return filters.merged_messages(fx.events(spark, sf)).select("id", "type", "timestamp")


@query(
    "fresh_events",
    """SELECT id, processed_at - (timestamp + 1609459200) * 1000 AS age_ms FROM stream_events
       WHERE processed_at - (timestamp + 1609459200) * 1000 <= 60000""",
    ("stream_events",),
)
def _(spark, sf):
    return filters.fresh(fx.events(spark, sf)).select("id", filters.latency_ms().alias("age_ms"))


@query(
    "linked_casts",
    "SELECT * FROM live_casts WHERE Embeds LIKE '%url%' ORDER BY Hash LIMIT 100",
    ("live_casts",),
)
def _(spark, sf):
    return analytics.linked_casts(state.live_casts(fx.casts(spark, sf)))


@query(
    "between_times",
    "SELECT * FROM casts WHERE Fid = 3 AND Timestamp BETWEEN 94650000 AND 94800000",
    ("casts",),
)
def _(spark, sf):
    return filters.between_times(fx.casts(spark, sf), 3, 94_650_000, 94_800_000)


@query(
    "completeness",
    """SELECT count(*) AS received, count(message_kind) AS good,
              count(*) - count(message_kind) AS bad FROM stream_events""",
    ("stream_events",),
)
def _(spark, sf):
    return filters.completeness(fx.events(spark, sf).select("merge_message_body.message.*"))


@query(
    "complete_messages",
    "SELECT '0x' || hash AS Hash FROM stream_events WHERE message_kind IS NOT NULL",
    ("stream_events",),
)
def _(spark, sf):
    messages = fx.events(spark, sf).select("merge_message_body.message.*")
    return filters.complete(messages).select(codec.hex_text(F.col("hash")).alias("Hash"))


@query(
    "error_column",
    """SELECT event_id, k AS parsed, false AS failed FROM ev""",
    ("ev",),
)
def _(spark, sf):
    return normalize.keep_parsable(
        fx.table(spark, sf, "events"),
        "parsed",
        F.get_json_object("props", "$.k").try_cast("bigint"),
    ).select("event_id", "parsed", "failed")
