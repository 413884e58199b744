"""Keyed lookups and paging."""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import functions as F

from socialog.operators import lookup, ordering, state
from socialog.plans import fixtures as fx
from socialog.plans.catalog import query
from socialog.sources import tables

FID = 3
ROOT_HASH = "0x" + md5(b"c:0:0").hexdigest()  # first cast of conversation 0, by user 0
LIVE_HASH = "0x" + md5(b"c:1:0").hexdigest()  # first cast of conversation 1, by user 1
ROOT_REF = f"0:{ROOT_HASH}"
REACTED_HASH = "0x" + md5(b"c:16:0").hexdigest()  # cast of user 1
REACTED_REF = f"1:{REACTED_HASH}"
URL = "https://example.com/27"
ADDRESS = "0x" + md5(b"a:3").hexdigest()  # custody address of user 3


def _casts(spark, sf):
    return state.live_casts(fx.casts(spark, sf))


def _reactions(spark, sf):
    return state.live_reactions(fx.reactions(spark, sf), by_url=True)


def _links(spark, sf):
    return state.live_links(fx.links(spark, sf))


_BY_URL = """(SELECT * EXCLUDE (place) FROM (
    SELECT *, rank() OVER (PARTITION BY Fid, TargetCastId, ReactionType, TargetUrl
                           ORDER BY Timestamp DESC) AS place FROM reactions)
    WHERE place = 1 AND MessageType = 'ReactionAdd') r"""

for _kind in fx.FLAT:

    @query(f"all_{_kind}_of_fid", f"SELECT * FROM {_kind} WHERE Fid = {FID}", (_kind,))
    def _(spark, sf, kind=_kind):
        return lookup.by_fid(fx.FLAT[kind](spark, sf), FID)


@query(
    "casts_by_parent_cast",
    f"SELECT * FROM live_casts WHERE ParentCastId = '{ROOT_REF}'",
    ("live_casts",),
)
def _(spark, sf):
    return lookup.casts_by_parent(_casts(spark, sf), cast_id=(0, ROOT_HASH))


@query(
    "casts_by_parent_url",
    "SELECT * FROM live_casts WHERE ParentUrl = (SELECT url FROM pages WHERE page_id = 2)",
    ("live_casts",),
)
def _(spark, sf):
    url = fx.table(spark, sf, "pages").filter("page_id = 2").first()["url"]
    return lookup.casts_by_parent(_casts(spark, sf), url=url)


@query(
    "casts_mentioning",
    f"SELECT * FROM live_casts WHERE list_contains(string_split(Mentions, ','), '{FID}')",
    ("live_casts",),
)
def _(spark, sf):
    return lookup.casts_mentioning(_casts(spark, sf), FID)


@query(
    "cast_by_id",
    f"""SELECT * FROM live_casts WHERE (Fid = 1 AND Hash = '{LIVE_HASH}')
        OR (Fid = 0 AND Hash = '{ROOT_HASH}')""",
    ("live_casts",),
)
def _(spark, sf):
    """A cast that is live, and one that was removed and gives no row."""
    casts = _casts(spark, sf)
    found = lookup.cast_by_id(casts, 1, LIVE_HASH)
    return found.unionByName(lookup.cast_by_id(casts, 0, ROOT_HASH))


@query(
    "reactions_of_fid",
    f"SELECT * FROM {_BY_URL} WHERE Fid = {FID} AND ReactionType = 'Like'",
    ("reactions",),
)
def _(spark, sf):
    return lookup.reactions_by_fid(_reactions(spark, sf), FID, "Like")


@query(
    "reactions_by_target_cast",
    f"SELECT * FROM {_BY_URL} WHERE TargetCastId = '{REACTED_REF}'",
    ("reactions",),
)
def _(spark, sf):
    return lookup.reactions_by_target(_reactions(spark, sf), cast_id=(1, REACTED_HASH))


@query(
    "reactions_by_target_url",
    f"SELECT * FROM {_BY_URL} WHERE TargetUrl = '{URL}' AND ReactionType = 'Recast'",
    ("reactions",),
)
def _(spark, sf):
    return lookup.reactions_by_target(_reactions(spark, sf), url=URL, kind="Recast")


@query(
    "one_reaction",
    f"""SELECT * FROM {_BY_URL}
        WHERE Fid = 1 AND ReactionType = 'Like' AND TargetCastId = '{REACTED_REF}'""",
    ("reactions",),
)
def _(spark, sf):
    return lookup.reaction(_reactions(spark, sf), 1, "Like", cast_id=(1, REACTED_HASH))


@query(
    "links_of_fid",
    f"SELECT * FROM live_links WHERE Fid = {FID} AND LinkType = 'follow'",
    ("live_links",),
)
def _(spark, sf):
    return lookup.links_by_fid(_links(spark, sf), FID, "follow")


@query("links_by_target", "SELECT * FROM live_links WHERE TargetFid = 7", ("live_links",))
def _(spark, sf):
    return lookup.links_by_target(_links(spark, sf), 7)


@query(
    "one_link",
    f"SELECT * FROM live_links WHERE Fid = {FID} AND LinkType = 'follow' AND TargetFid = 2",
    ("live_links",),
)
def _(spark, sf):
    return lookup.link(_links(spark, sf), FID, "follow", 2)


_NEWEST = """(SELECT Fid, UserDataType, Value, Timestamp FROM profiles
    QUALIFY row_number() OVER (PARTITION BY Fid, UserDataType
                               ORDER BY Timestamp DESC, Hash DESC) = 1) p"""


@query("user_data_of_fid", f"SELECT * FROM {_NEWEST} WHERE Fid = {FID}", ("profiles",))
def _(spark, sf):
    return lookup.user_data(fx.profiles(spark, sf), FID)


@query(
    "user_data_field",
    f"SELECT * FROM {_NEWEST} WHERE Fid = {FID} AND UserDataType = 'Bio'",
    ("profiles",),
)
def _(spark, sf):
    return lookup.user_data(fx.profiles(spark, sf), FID, "Bio")


@query(
    "verifications_of_fid", f"SELECT * FROM verifications WHERE fid = {FID}", ("verifications",)
)
def _(spark, sf):
    return lookup.verifications(fx.verifications(spark, sf), FID)


@query(
    "one_verification",
    """SELECT * FROM verifications
       WHERE fid = (SELECT o_custkey FROM orders WHERE o_orderkey = 3) AND seq = 3""",
    ("verifications",),
)
def _(spark, sf):
    fid = fx.table(spark, sf, "orders").filter("o_orderkey = 3").first()["o_custkey"]
    return lookup.verifications(fx.verifications(spark, sf), fid, ADDRESS)


@query(
    "fids_of_shard",
    "SELECT DISTINCT Fid FROM shards WHERE shard = 1 ORDER BY Fid DESC LIMIT 100",
    ("shards",),
)
def _(spark, sf):
    return lookup.fids_of_shard(fx.shards(spark, sf), 1, 100, reverse=True)


@query(
    "event_by_id",
    "SELECT id, type, timestamp, processed_at FROM stream_events WHERE id = 77",
    ("stream_events",),
)
def _(spark, sf):
    return lookup.event_by_id(fx.events(spark, sf), 77).select(
        "id", "type", "timestamp", "processed_at"
    )


@query("address_roles", "SELECT * FROM roles", ("roles",))
def _(spark, sf):
    return lookup.address_roles(fx.custody(spark, sf), fx.verifications(spark, sf))


@query(
    "address_role",
    f"SELECT * FROM roles WHERE fid = {FID} AND address = '{ADDRESS}'",
    ("roles",),
)
def _(spark, sf):
    return lookup.address_role(fx.custody(spark, sf), fx.verifications(spark, sf), FID, ADDRESS)


# ---- pages -----------------------------------------------------------------

_PAGED = ("Fid", "MessageType", "Timestamp", "Hash")


@query(
    "second_page",
    f"""SELECT {', '.join(_PAGED)} FROM reactions WHERE Fid = {FID}
        ORDER BY Timestamp, Hash LIMIT 20 OFFSET 20""",
    ("reactions",),
)
def _(spark, sf):
    rows = lookup.by_fid(fx.reactions(spark, sf), FID).select(*_PAGED)
    keys = ["Timestamp", "Hash"]
    first = ordering.page(rows, keys, 20)
    return ordering.page(rows, keys, 20, first.next_token).rows


@query(
    "second_page_reverse",
    f"""SELECT {', '.join(_PAGED)} FROM casts
        ORDER BY Timestamp DESC, Hash DESC LIMIT 25 OFFSET 25""",
    ("casts",),
)
def _(spark, sf):
    rows = fx.casts(spark, sf).select(*_PAGED)
    keys = ["Timestamp", "Hash"]
    first = ordering.page(rows, keys, 25, reverse=True)
    return ordering.page(rows, keys, 25, first.next_token, reverse=True).rows


@query(
    "page_numbers",
    """SELECT Fid, Hash,
              (row_number() OVER (PARTITION BY Fid ORDER BY Timestamp, Hash) - 1) // 100 + 1 AS page_no
       FROM reactions""",
    ("reactions",),
)
def _(spark, sf):
    rows = fx.reactions(spark, sf).select("Fid", "Timestamp", "Hash")
    return ordering.page_numbers(rows, ["Fid"], 100, "Timestamp", "Hash").drop("Timestamp")


@query(
    "newest_event",
    "SELECT id, type, timestamp FROM stream_events ORDER BY id DESC LIMIT 1",
    ("stream_events",),
)
def _(spark, sf):
    return tables.newest(fx.events(spark, sf), "id").select("id", "type", "timestamp")


@query(
    "union_of_shards",
    "SELECT shard, Fid, count(*) AS n FROM shards GROUP BY ALL",
    ("shards",),
)
def _(spark, sf):
    rows = fx.shards(spark, sf)
    lists = [
        rows.filter(F.col("shard") == s).groupBy("shard", "Fid").agg(F.count(F.lit(1)).alias("n"))
        for s in range(3)
    ]
    return tables.union_shards(*lists)
