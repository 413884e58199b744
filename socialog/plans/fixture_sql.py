"""The fixture views of ``fixtures`` as SQL, and the state tables on them."""

from __future__ import annotations

_EMBED_URL = """'{ "url": "' || url || '" }'"""
_EMBED_CAST = (
    """'{ "castId": { "fid": "' || parent_fid || '", "hash": "' || parent_hash || '" } }'"""
)
_SIGNED = "'Ed25519' AS SignatureScheme, '' AS Signature, '' AS Signer"
_CAST_NAMES = "Text, Mentions, ParentCastId, ParentUrl, Embeds, TargetHash"

# name -> (views it reads, body)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "ev": (
        (),
        """
        SELECT event_id, user_id, event_type, value,
               CAST(floor(epoch(ts)) AS BIGINT) AS sec,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               CAST(json_extract_string(props, '$.k') AS BIGINT) % 20 AS c
        FROM events""",
    ),
    "links": (
        ("ev",),
        f"""
        SELECT user_id AS Fid,
               CASE event_type WHEN 'purchase' THEN 'LinkAdd' ELSE 'LinkRemove' END AS MessageType,
               sec - sec % 3600 - 1609459200 AS Timestamp,
               '0x' || md5('l:' || event_id) AS Hash, {_SIGNED},
               'follow' AS LinkType, k % 10 AS TargetFid, CAST(0 AS BIGINT) AS DisplayTimestamp
        FROM ev WHERE event_type IN ('purchase', 'error')""",
    ),
    "reactions": (
        ("ev",),
        f"""
        SELECT user_id AS Fid,
               CASE event_type WHEN 'error' THEN 'ReactionRemove' ELSE 'ReactionAdd' END AS MessageType,
               sec - 1609459200 AS Timestamp,
               '0x' || md5('x:' || event_id) AS Hash, {_SIGNED},
               CASE WHEN k % 2 = 0 THEN 'Like' ELSE 'Recast' END AS ReactionType,
               CASE WHEN k % 9 = 0 THEN ''
                    ELSE (c % 15) || ':0x' || md5('c:' || c || ':0') END AS TargetCastId,
               CASE WHEN k % 9 = 0 THEN 'https://example.com/' || k ELSE '' END AS TargetUrl
        FROM ev WHERE event_type IN ('click', 'view', 'error')""",
    ),
    "profiles": (
        ("ev",),
        f"""
        SELECT user_id AS Fid, 'UserDataAdd' AS MessageType, sec - 1609459200 AS Timestamp,
               '0x' || md5('u:' || event_id) AS Hash, {_SIGNED},
               f AS UserDataType, 'v' || lpad(CAST(k AS VARCHAR), 3, '0') AS Value,
               CASE f WHEN 'Pfp' THEN 'Profile Picture' WHEN 'Display' THEN 'Display Name'
                      WHEN 'Bio' THEN 'Bio' WHEN 'Url' THEN 'URL' ELSE 'Unknown' END
                   AS UserDataTypeReadable
        FROM (SELECT *, CASE k % 7 WHEN 0 THEN 'Username' WHEN 1 THEN 'Display'
                     WHEN 2 THEN 'Location' WHEN 3 THEN 'Pfp' WHEN 4 THEN 'Bio'
                     WHEN 5 THEN 'Twitter' ELSE 'Url' END AS f
              FROM ev WHERE event_type = 'signup')""",
    ),
    "turns": (
        (),
        """
        SELECT conv_id, turn, text, url, (conv_id + turn) % 15 AS fid,
               (conv_id + turn - 1) % 15 AS parent_fid,
               '0x' || md5('c:' || conv_id || ':' || turn) AS cast_hash,
               '0x' || md5('c:' || conv_id || ':' || (turn - 1)) AS parent_hash,
               94608000 + conv_id * 3600 + turn * 60 AS made_at
        FROM conversations
        LEFT JOIN pages ON page_id = conv_id % (SELECT count(*) FROM pages)""",
    ),
    "casts": (
        ("turns",),
        f"""
        SELECT fid AS Fid, 'CastAdd' AS MessageType, made_at AS Timestamp, cast_hash AS Hash, {_SIGNED},
               text AS Text,
               CASE WHEN turn % 3 = 0 THEN (conv_id % 15) || ',' || ((conv_id + 2) % 15)
                    ELSE '' END AS Mentions,
               CASE WHEN turn > 0 THEN parent_fid || ':' || parent_hash ELSE '' END AS ParentCastId,
               CASE WHEN turn = 0 AND conv_id % 2 = 0 THEN url ELSE '' END AS ParentUrl,
               CASE turn % 4 WHEN 1 THEN {_EMBED_URL} WHEN 2 THEN {_EMBED_CAST}
                    WHEN 3 THEN {_EMBED_URL} || '|' || {_EMBED_CAST} ELSE '' END AS Embeds,
               '' AS TargetHash
        FROM turns
        UNION ALL
        SELECT fid, 'CastRemove', made_at + 30, '0x' || md5('r:' || conv_id || ':' || turn), {_SIGNED},
               '', '', '', '', '', cast_hash
        FROM turns WHERE (conv_id + turn) % 7 = 0""",
    ),
    "stream_events": (
        ("ev",),
        """
        SELECT event_id AS id,
               CASE event_type WHEN 'signup' THEN 'PRUNE_MESSAGE' ELSE 'MERGE_MESSAGE' END AS type,
               CASE WHEN event_type IN ('click', 'view') THEN 'CastAdd'
                    WHEN event_type = 'error' THEN 'CastRemove'
                    WHEN event_type = 'purchase' THEN 'LinkAdd' END AS message_kind,
               sec - 1609459200 AS timestamp, user_id AS fid, user_id % 3 AS shard_index,
               md5('e:' || event_id) AS hash, (sec + k) * 1000 AS processed_at, k, c
        FROM ev""",
    ),
    "normalized": (
        ("stream_events",),
        """
        SELECT fid, hash, timestamp, processed_at, id AS event_id,
               CASE message_kind WHEN 'CastAdd' THEN 'cast_add' ELSE 'cast_remove' END AS message_type,
               CASE message_kind WHEN 'CastAdd' THEN 'casts_add' ELSE 'casts_remove' END AS queue,
               CASE message_kind WHEN 'CastAdd' THEN 'event ' || id END AS text,
               CASE WHEN message_kind = 'CastAdd' AND k % 3 = 0
                    THEN (k % 15) || ',' || ((k + 2) % 15) END AS mentions,
               CASE WHEN message_kind = 'CastAdd' AND k % 4 = 1
                    THEN md5('c:' || c || ':0') END AS parent_hash,
               CAST(NULL AS VARCHAR) AS parent_url,
               CASE WHEN message_kind = 'CastAdd' AND k % 5 = 0
                    THEN 'https://example.com/' || k END AS embed_urls,
               CASE WHEN message_kind = 'CastRemove' THEN md5('e:' || (id - 1)) END AS target_hash,
               processed_at - (timestamp + 1609459200) * 1000 AS latency_ms, k, message_kind
        FROM stream_events WHERE message_kind IS NOT NULL""",
    ),
    "delivered": (
        ("normalized",),
        """
        SELECT *, CASE WHEN latency_ms > 5000 THEN 'high' WHEN latency_ms < 1000
                       THEN 'near real time' ELSE 'normal' END AS latency_band
        FROM normalized
        WHERE message_kind IN ('CastAdd', 'CastRemove') AND latency_ms <= 60000""",
    ),
    "live_casts": (
        ("casts",),
        """
        SELECT * FROM casts a WHERE MessageType = 'CastAdd' AND NOT EXISTS
            (SELECT 1 FROM casts r WHERE r.MessageType = 'CastRemove' AND r.TargetHash = a.Hash)""",
    ),
    "live_reactions": (
        ("reactions",),
        """
        SELECT * EXCLUDE (place) FROM (
            SELECT *, rank() OVER (PARTITION BY Fid, TargetCastId, ReactionType
                                   ORDER BY Timestamp DESC) AS place FROM reactions)
        WHERE place = 1 AND MessageType = 'ReactionAdd'""",
    ),
    "live_links": (
        ("links",),
        """
        SELECT * EXCLUDE (place) FROM (
            SELECT *, rank() OVER (PARTITION BY Fid, TargetFid, LinkType
                                   ORDER BY Timestamp DESC) AS place FROM links)
        WHERE place = 1 AND MessageType = 'LinkAdd'""",
    ),
    "shards": ((), "SELECT user_id AS Fid, user_id % 3 AS shard FROM events"),
    "tiers": (
        (),
        """
        SELECT c_custkey AS fid,
               CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN
                    CASE WHEN c_nationkey < 12 THEN CAST(1735689600 AS BIGINT)
                         ELSE CAST(1672531200 AS BIGINT) END END AS pro_expires_at
        FROM customer""",
    ),
    "active_pro": (
        ("tiers",),
        "SELECT fid, pro_expires_at AS expires_at FROM tiers WHERE pro_expires_at > 1704067200",
    ),
    "verifications": (
        (),
        """
        SELECT o_custkey AS fid, 'VerificationAddEthAddress' AS type,
               CAST(epoch(o_orderdate) AS BIGINT) AS timestamp,
               '0x' || md5('a:' || o_orderkey) AS address,
               CASE WHEN o_orderstatus <> 'P' THEN 'Ethereum' ELSE 'Solana' END AS protocol,
               o_orderkey AS seq
        FROM orders""",
    ),
    "latest_addresses": (
        ("verifications",),
        """
        SELECT fid, address FROM verifications WHERE protocol = 'Ethereum'
        QUALIFY row_number() OVER (PARTITION BY fid ORDER BY timestamp DESC, seq) = 1""",
    ),
    "link_states": (
        ("ev",),
        f"""
        SELECT user_id AS Fid, 'LinkCompactState' AS MessageType,
               sec - sec % 3600 - 1609459200 AS Timestamp,
               '0x' || md5('k:' || event_id) AS Hash, {_SIGNED}, 'follow' AS LinkType,
               [k % 10, (k + 3) % 10, (k + 7) % 10] AS TargetFids
        FROM ev WHERE event_type = 'signup'""",
    ),
    "live_compacted_links": (
        ("links", "link_states"),
        """
        SELECT * EXCLUDE (place) FROM (
            SELECT *, rank() OVER (PARTITION BY Fid, TargetFid, LinkType
                                   ORDER BY Timestamp DESC) AS place
            FROM (SELECT l.* FROM links l LEFT JOIN (
                      SELECT Fid, LinkType, max(Timestamp) AS since FROM link_states GROUP BY ALL) s
                      USING (Fid, LinkType)
                  WHERE since IS NULL OR Timestamp > since
                  UNION ALL
                  SELECT Fid, 'LinkAdd', Timestamp, Hash, SignatureScheme, Signature, Signer, LinkType,
                         unnest(TargetFids), 0
                  FROM (FROM link_states QUALIFY row_number() OVER (
                            PARTITION BY Fid, LinkType ORDER BY Timestamp DESC, Hash DESC) = 1)))
        WHERE place = 1 AND MessageType = 'LinkAdd'""",
    ),
    "verification_log": (
        (),
        f"""
        SELECT o_custkey AS Fid, m AS MessageType,
               CAST(epoch(o_orderdate) - epoch(TIMESTAMP '1990-01-01') AS BIGINT) + later AS Timestamp,
               '0x' || md5(kind || ':' || o_orderkey) AS Hash, {_SIGNED},
               '0x' || md5('a:' || o_orderkey) AS Address,
               CASE WHEN o_orderstatus <> 'P' THEN 'Ethereum' ELSE 'Solana' END AS Protocol
        FROM orders JOIN (VALUES ('VerificationAddEthAddress', 'add', 0),
                                 ('VerificationRemove', 'gone', 86400)) v(m, kind, later)
             ON kind = 'add' OR o_orderkey % 5 = 0""",
    ),
    "live_verifications": (
        ("verification_log",),
        """
        SELECT * EXCLUDE (place) FROM (
            SELECT *, rank() OVER (PARTITION BY Fid, Address ORDER BY Timestamp DESC) AS place
            FROM verification_log)
        WHERE place = 1 AND MessageType = 'VerificationAddEthAddress'""",
    ),
    "live_addresses": (
        ("live_verifications",),
        """
        SELECT Fid AS fid, Address AS address FROM live_verifications WHERE Protocol = 'Ethereum'
        QUALIFY row_number() OVER (PARTITION BY Fid ORDER BY Timestamp DESC, Hash) = 1""",
    ),
    "roles": (
        ("verifications",),
        """
        SELECT fid, address, bool_or(c) AS is_custody, bool_or(a) AS is_auth, bool_or(v) AS is_verified
        FROM (SELECT c_custkey AS fid, '0x' || md5('a:' || c_custkey) AS address,
                     true AS c, false AS a, false AS v FROM customer
              UNION ALL
              SELECT c_custkey, '0x' || md5('b:' || c_custkey), false, true, false FROM customer
              UNION ALL
              SELECT fid, address, false, false, true FROM verifications)
        GROUP BY fid, address""",
    ),
    "calls": (
        ("ev",),
        """
        SELECT event_id, event_type AS context, event_type <> 'error' AS ok,
               CASE WHEN event_type = 'error' THEN 'code' || (k % 4) END AS error_type,
               k % 4 AS retries, value AS latency_ms, sec AS called_at, k
        FROM ev""",
    ),
    "batch_log": (
        ("calls",),
        """
        SELECT event_id // 100 AS batch_no, count(*) AS rows, CAST(sum(k) AS BIGINT) AS bytes,
               max(k) AS flush_ms FROM calls GROUP BY 1""",
    ),
    "sweep_log": (
        ("ev",),
        """
        SELECT user_id AS Fid, count(*) AS messages, CAST(sum(k) AS BIGINT) AS elapsed_ms
        FROM ev GROUP BY 1""",
    ),
}


def with_views(query: str, *names: str) -> str:
    """``query`` behind the views it names and the views those read."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in VIEWS[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return query.strip()
    heads = ",\n".join(f"{name} AS ({VIEWS[name][1]})" for name in ordered)
    return f"WITH {heads}\n{query.strip()}"
