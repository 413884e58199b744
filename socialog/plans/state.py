"""Current state, replies and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from socialog.operators import graph, state
from socialog.plans import fixtures as fx
from socialog.plans.catalog import query

LIVE_SQL = {kind: f"SELECT * FROM live_{kind}" for kind in ("casts", "reactions", "links")}


@query("live_casts", LIVE_SQL["casts"], ("live_casts",))
def _(spark, sf):
    return state.live_casts(fx.casts(spark, sf))


for _name, _how in (("", state.live), ("_ranked", state.live_ranked), ("_joined", state.live_joined)):

    @query(f"live_reactions{_name}", LIVE_SQL["reactions"], ("live_reactions",))
    def _(spark, sf, how=_how):
        return state.live_reactions(fx.reactions(spark, sf), how=how)

    @query(f"live_links{_name}", LIVE_SQL["links"], ("live_links",))
    def _(spark, sf, how=_how):
        return state.live_links(fx.links(spark, sf), how=how)


@query(
    "live_reactions_by_url",
    """SELECT * EXCLUDE (place) FROM (
           SELECT *, rank() OVER (PARTITION BY Fid, TargetCastId, ReactionType, TargetUrl
                                  ORDER BY Timestamp DESC) AS place FROM reactions)
       WHERE place = 1 AND MessageType = 'ReactionAdd'""",
    ("reactions",),
)
def _(spark, sf):
    return state.live_reactions(fx.reactions(spark, sf), by_url=True)


@query(
    "latest_seconds",
    """SELECT Fid, TargetCastId, ReactionType, max(Timestamp) AS Timestamp
       FROM reactions GROUP BY ALL""",
    ("reactions",),
)
def _(spark, sf):
    return state.latest_seconds(fx.reactions(spark, sf), state.REACTION_KEY)


@query(
    "profile_wide_max",
    "SELECT Fid, "
    + ", ".join(f"max(Value) FILTER (UserDataType = '{f}') AS {f}" for f in state.WIDE_FIELDS)
    + " FROM profiles GROUP BY Fid",
    ("profiles",),
)
def _(spark, sf):
    return state.wide_profiles(fx.profiles(spark, sf))


@query(
    "profile_wide_latest",
    "SELECT Fid, "
    + ", ".join(f"max(Value) FILTER (UserDataType = '{f}') AS {f}" for f in state.WIDE_FIELDS)
    + """ FROM (SELECT p.*, row_number() OVER (PARTITION BY Fid, UserDataType
                       ORDER BY Timestamp DESC, Hash DESC) AS place FROM profiles p)
          WHERE place = 1 GROUP BY Fid""",
    ("profiles",),
)
def _(spark, sf):
    return state.latest_profiles(fx.profiles(spark, sf))


@query("active_pro", "SELECT fid, expires_at FROM active_pro", ("active_pro",))
def _(spark, sf):
    return state.active_pro(fx.tiers(spark, sf), fx.NOW)


@query("latest_addresses", "SELECT fid, address FROM latest_addresses", ("latest_addresses",))
def _(spark, sf):
    return state.latest_addresses(fx.verifications(spark, sf))


@query(
    "pro_members",
    """SELECT p.fid AS FID, coalesce(a.address, '') AS PrimaryEthAddress
       FROM active_pro p LEFT JOIN latest_addresses a ON a.fid = p.fid""",
    ("active_pro", "latest_addresses"),
)
def _(spark, sf):
    return state.pro_members(fx.tiers(spark, sf), fx.verifications(spark, sf), fx.NOW)


@query(
    "compact_link_state",
    """SELECT Fid, LinkType, CAST(0 AS BIGINT) AS Part, count(DISTINCT TargetFid) AS n,
              string_agg(DISTINCT TargetFid, ',' ORDER BY TargetFid) AS targets
       FROM live_links GROUP BY Fid, LinkType""",
    ("live_links",),
)
def _(spark, sf):
    pieces = state.compact_links(state.live_links(fx.links(spark, sf)))
    return pieces.select(
        "Fid",
        "LinkType",
        "Part",
        F.size("TargetFids").cast("long").alias("n"),
        F.array_join("TargetFids", ",").alias("targets"),
    )


@query(
    "replies",
    """SELECT a.Fid, a.Hash, a.Timestamp, a.pf AS ParentFid, a.ph AS ParentHash,
              p.Timestamp AS ParentTimestamp, a.Timestamp - p.Timestamp AS DelaySeconds
       FROM (SELECT *, CAST(split_part(ParentCastId, ':', 1) AS BIGINT) AS pf,
                    split_part(ParentCastId, ':', 2) AS ph
             FROM live_casts WHERE ParentCastId <> '') a
       LEFT JOIN live_casts p ON p.Fid = a.pf AND p.Hash = a.ph""",
    ("live_casts",),
)
def _(spark, sf):
    return graph.replies(state.live_casts(fx.casts(spark, sf)))


@query(
    "user_edges",
    """SELECT Src, Dst, Kind, count(*) AS N FROM (
           SELECT Fid AS Src, CAST(unnest(string_split(Mentions, ',')) AS BIGINT) AS Dst,
                  'mention' AS Kind FROM live_casts WHERE Mentions <> ''
           UNION ALL
           SELECT Fid, CAST(split_part(ParentCastId, ':', 1) AS BIGINT), 'reply'
           FROM live_casts WHERE ParentCastId <> '')
       GROUP BY ALL""",
    ("live_casts",),
)
def _(spark, sf):
    return graph.user_edges(state.live_casts(fx.casts(spark, sf)))


@query(
    "reconcile_live_links",
    """SELECT count(*) AS source_ids, count(*) FILTER (live) AS sink_ids,
              count(*) FILTER (NOT live) AS missing, CAST(0 AS BIGINT) AS unexpected,
              CAST(0 AS BIGINT) AS duplicated
       FROM (SELECT Hash IN (SELECT Hash FROM live_links) AS live FROM links)""",
    ("live_links",),
)
def _(spark, sf):
    log = fx.links(spark, sf)
    return graph.reconcile(log, state.live_links(log), ["Hash"])
