"""Lookup by what a cast holds: an inverted table of mentions and embeds.

A posting is (Kind, Term, Timestamp, Fid, Hash): a cast mentions a user, embeds a URL or
a page of a host, or answers a cast or a URL. Postings are stored by term, so a lookup reads the row groups of its
term alone and then fetches the casts; the casts' texts are never searched. Terms
that very many casts share are cut by time like any other range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from socialog.functions import codec
from socialog.operators.state import spread_distinct
from socialog.sources import sinks

MENTION, HOST, URL, PARENT = "mention", "host", "url", "parent"
ROW_GROUP = 20_000


def postings(casts: DataFrame) -> DataFrame:
    """Each term of each cast added, once: one narrow pass, no shuffle."""
    embeds = F.filter(codec.parse_embeds(F.col("Embeds")), lambda e: e["url"].isNotNull())
    urls = F.array_distinct(F.transform(embeds, lambda e: e["url"]))
    hosts = F.array_distinct(F.transform(urls, lambda u: F.lower(F.try_parse_url(u, F.lit("HOST")))))

    def terms(kind: str, values: Column) -> Column:
        known = F.filter(values.cast("array<string>"), lambda v: v.isNotNull())
        term = F.transform(known, lambda v: F.struct(F.lit(kind).alias("Kind"), v.alias("Term")))
        return F.coalesce(term, F.array().cast("array<struct<Kind: string, Term: string>>"))

    mentions = F.array_distinct(codec.parse_mentions(F.col("Mentions")))
    parents = F.array_remove(F.array("ParentCastId", "ParentUrl"), "")
    every = F.concat(terms(MENTION, mentions), terms(URL, urls), terms(HOST, hosts), terms(PARENT, parents))
    return (
        casts.filter(F.col("MessageType") == "CastAdd")
        .select(F.explode(every).alias("_term"), "Timestamp", "Fid", "Hash")
        .select("_term.*", "Timestamp", "Fid", "Hash")
    )


def live_postings(found: DataFrame, log: DataFrame) -> DataFrame:
    """Postings whose cast no remove of ``log`` names; only postings and hashes move."""
    removed = spread_distinct(log.filter(F.col("MessageType") == "CastRemove"), "TargetHash", F.col("Hash"))
    return found.join(removed.withColumnRenamed("TargetHash", "Hash"), "Hash", "left_anti").select(*found.columns)


def write_postings(found: DataFrame, path: str, row_group: int = ROW_GROUP, mode: str = "errorifexists") -> None:
    """Store postings by term and time, in row groups that a lookup can skip."""
    in_order = sinks.clustered(found, "Kind", "Term", "Timestamp")
    in_order.write.mode(mode).option("parquet.block.row.count.limit", row_group).parquet(path)


def of_term(stored: DataFrame, kind: str, term: str | int) -> DataFrame:
    return stored.filter((F.col("Kind") == kind) & (F.col("Term") == str(term)))


def of_prefix(stored: DataFrame, kind: str, start: str) -> DataFrame:
    return stored.filter((F.col("Kind") == kind) & F.col("Term").startswith(start))


def casts_of(found: DataFrame, casts: DataFrame) -> DataFrame:
    """The casts that postings name, each row once."""
    keys = found.select("Fid", "Hash").distinct()
    return casts.join(keys, ["Fid", "Hash"], "left_semi").select(*casts.columns)


def newest_casts_of(found: DataFrame, casts: DataFrame, n: int = 100) -> DataFrame:
    """The newest ``n`` casts that postings name; ties by user and hash.

    Their keys, ``n`` at most, reach the scan of the casts as sets.
    """
    newest = found.select("Timestamp", "Fid", "Hash").distinct().orderBy(F.desc("Timestamp"), "Fid", "Hash").limit(n)
    keys = newest.collect()
    fids, digests = {r["Fid"] for r in keys}, {r["Hash"] for r in keys}
    return casts.filter(F.col("Fid").isin(fids) & F.col("Hash").isin(digests) & (F.col("MessageType") == "CastAdd"))
