"""Reconciliation that moves little: a tree of check sums over id ranges.

Both sides are summed up by id range, ``fan`` ranges at a time: rows and the sum of
their id hashes. Ranges with equal sums are done; only those that differ are cut again and
summed again, with the ranges as a pushed filter, so row groups of equal ranges
are not read a second time where ids are stored in order. Ids are listed only in ranges
that differ and are small. What moves is ``fan`` rows a level, then the ids in doubt.

Sums are of 64-bit hashes: two sides that differ agree by chance once in 2^64 ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN = 1024
LEAF = 4096  # ids of a range that is listed
MOST = 256  # ranges that differ and are cut further; with more, all of them are listed

Range = tuple[int, int]


def _within(ranges: list[Range], key: Column) -> Column:
    """Whether an id lies in one of the ranges; neighbours are one range."""
    joined: list[list[int]] = []
    for low, high in sorted(ranges):
        if joined and low <= joined[-1][1] + 1:
            joined[-1][1] = max(high, joined[-1][1])
        else:
            joined.append([low, high])
    condition = F.lit(False)
    for low, high in joined:
        condition = condition | key.between(low, high)
    return condition


def _sums(side: DataFrame, key: str, ranges: list[Range], width: int) -> DataFrame:
    """Rows and check sum of each piece of ``width`` ids, for the ids in ``ranges``."""
    piece = F.floor((F.col(key) - F.lit(ranges[0][0])) / width).cast("long")
    return (
        side.filter(_within(ranges, F.col(key)))
        .groupBy(piece.alias("piece"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(key).cast("decimal(20,0)")).alias("hashes"))
    )


def differing(source: DataFrame, sink: DataFrame, key: str, fan: int = FAN, leaf: int = LEAF) -> list[Range]:
    """Id ranges in which the sides differ, ``leaf`` ids or less each unless more than MOST differ."""
    bounds = source.select(key).union(sink.select(key)).agg(F.min(key), F.max(key)).first()
    if bounds[0] is None:
        return []
    low, high = bounds
    ranges, size = [(low, high)], high - low + 1
    while ranges and size > leaf and len(ranges) <= MOST:
        pieces = max(2, fan // len(ranges))
        width = max(leaf, -(-size // pieces))
        begin = ranges[0][0]
        a, b = (_sums(side, key, ranges, width) for side in (source, sink))
        found = (
            a.withColumnsRenamed({"n": "n_a", "hashes": "hashes_a"})
            .join(b, "piece", "full")
            .filter(~(F.col("n_a").eqNullSafe(F.col("n")) & F.col("hashes_a").eqNullSafe(F.col("hashes"))))
            .select("piece")
            .collect()  # at most about fan rows: pieces of the ranges that differed
        )
        ranges = sorted((begin + r["piece"] * width, begin + (r["piece"] + 1) * width - 1) for r in found)
        size = width
    return ranges


def differences(source: DataFrame, sink: DataFrame, key: str, fan: int = FAN, leaf: int = LEAF) -> DataFrame:
    """(key, sent, got) of ids that one side lacks or that came more often than they were sent.

    ``sent`` and ``got`` are the rows with that id; NULL ids are left out.
    """
    ranges = differing(source, sink, key, fan, leaf)
    inside = _within(ranges, F.col(key))

    def tagged(side: DataFrame, sent: int) -> DataFrame:
        return side.filter(inside).select(key, F.lit(sent).alias("_sent"))

    return (
        tagged(source, 1)
        .unionByName(tagged(sink, 0))
        .groupBy(key)
        .agg(F.sum("_sent").alias("sent"), F.sum(1 - F.col("_sent")).alias("got"))
        .filter("sent <> got")
    )
