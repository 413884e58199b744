"""Counts and top-N over the current-state tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from socialog.operators import analytics as an
from socialog.operators import state
from socialog.plans import fixtures as fx
from socialog.plans.catalog import query

_AT = "make_timestamp((Timestamp + 1609459200) * 1000000)"
_DAY = f"CAST({_AT} AS DATE)"
_MONTH = f"strftime({_AT}, '%Y-%m')"


def _casts(spark, sf):
    return state.live_casts(fx.casts(spark, sf))


def _reactions(spark, sf):
    return state.live_reactions(fx.reactions(spark, sf))


def _links(spark, sf):
    return state.live_links(fx.links(spark, sf))


@query("export_row_count", "SELECT count(DISTINCT Fid) AS n FROM profiles", ("profiles",))
def _(spark, sf):
    return an.row_count(state.wide_profiles(fx.profiles(spark, sf)))


@query(
    "casts_per_day",
    f"SELECT {_DAY} AS cast_date, count(*) AS daily_cast_count FROM live_casts GROUP BY 1 ORDER BY 1",
    ("live_casts",),
)
def _(spark, sf):
    return an.per_day(_casts(spark, sf), "cast_date", "daily_cast_count")


@query(
    "casts_per_month",
    f"SELECT {_MONTH} AS month, count(*) AS cast_count FROM live_casts GROUP BY 1 ORDER BY 1",
    ("live_casts",),
)
def _(spark, sf):
    return an.per_month(_casts(spark, sf), "month", "cast_count")


@query(
    "reply_share",
    """SELECT round(count(*) FILTER (ParentCastId <> '') * 100.0 / count(*), 6) AS reply_pct
       FROM live_casts""",
    ("live_casts",),
)
def _(spark, sf):
    return an.reply_share(_casts(spark, sf)).select(F.round("reply_pct", 6).alias("reply_pct"))


@query(
    "reactions_by_type",
    "SELECT ReactionType, count(*) AS reaction_count FROM live_reactions GROUP BY 1",
    ("live_reactions",),
)
def _(spark, sf):
    return an.reactions_by_type(_reactions(spark, sf))


@query(
    "reactions_per_day",
    f"""SELECT {_DAY} AS reaction_date, ReactionType, count(*) AS daily_reaction_count
        FROM live_reactions GROUP BY 1, 2 ORDER BY 1, 2""",
    ("live_reactions",),
)
def _(spark, sf):
    return an.reactions_per_day(_reactions(spark, sf))


@query(
    "reactions_by_month",
    f"""SELECT {_MONTH} AS month,
               nullif(count(*) FILTER (ReactionType = 'Like'), 0) AS "Like",
               nullif(count(*) FILTER (ReactionType = 'Recast'), 0) AS "Recast"
        FROM live_reactions GROUP BY 1 ORDER BY 1""",
    ("live_reactions",),
)
def _(spark, sf):
    return an.reactions_by_month(_reactions(spark, sf))


@query(
    "follows_per_day",
    f"SELECT {_DAY} AS follow_date, count(*) AS daily_follow_count FROM live_links GROUP BY 1 ORDER BY 1",
    ("live_links",),
)
def _(spark, sf):
    return an.per_day(_links(spark, sf), "follow_date", "daily_follow_count")


@query(
    "follows_per_month",
    f"SELECT {_MONTH} AS month, count(*) AS follow_count FROM live_links GROUP BY 1 ORDER BY 1",
    ("live_links",),
)
def _(spark, sf):
    return an.per_month(_links(spark, sf), "month", "follow_count")


_TOPS = {
    "top_posters": (an.top_posters, _casts, "casts", "Fid", "cast_count", 10),
    "top_reactors": (an.top_reactors, _reactions, "reactions", "Fid", "reaction_count", 20),
    "top_reacted_casts": (
        an.top_targets, _reactions, "reactions", "TargetCastId", "reaction_count", 10,
    ),
    "top_followed": (an.top_followed, _links, "links", "TargetFid", "follower_count", 20),
    "top_following": (an.top_followers, _links, "links", "Fid", "following_count", 20),
}

for _name, (_top, _source, _kind, _key, _n, _limit) in _TOPS.items():

    @query(
        _name,
        f"""SELECT {_key}, count(*) AS {_n} FROM live_{_kind} GROUP BY 1
            ORDER BY 2 DESC, 1 LIMIT {_limit}""",
        (f"live_{_kind}",),
    )
    def _(spark, sf, top=_top, source=_source):
        return top(source(spark, sf))


@query(
    "follower_counts",
    "SELECT TargetFid, count(*) AS follower_count FROM live_links GROUP BY 1",
    ("live_links",),
)
def _(spark, sf):
    return an.key_counts(_links(spark, sf), "TargetFid", "follower_count")
