"""Current state kept up from a stream: snapshot and delta.

The state of a log with a latest-event rule (``state.live``) is held as *cuts* by key
hash: for each key all rows at its newest second, adds and removes alike, so a late
event is judged as it would have been in order. A micro-batch is folded into the cuts
it touches: their rows and the batch's are reduced together and written anew, the other
cuts stay as they are. A version is a small table that names the path of each cut;
writing it is the switch, so readers see all of a batch or nothing.

Folding is a maximum over a set of messages told apart by hash: order, batching,
repeated messages and batches that run twice don't change the result. Work follows the
batch and the cuts it touches. Reducing is the narrow aggregate and semi join
of ``state.live``, so no task holds a key; cuts are written by size.

One stream writes a state folder at a time. Rows with a NULL in their key match nothing and are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from socialog.operators import state

VERSION = "version long, cut long, path string"


@dataclass(frozen=True)
class Kept:
    """A kept state: where it lies, what its key is, which messages add and remove."""

    folder: str
    key: tuple[str, ...]
    add: str
    remove: str
    cuts: int = 64  # of the key hash; fixed when a folder is begun


def kept_links(folder: str, cuts: int = 64) -> Kept:
    return Kept(folder, state.LINK_KEY, "LinkAdd", "LinkRemove", cuts)


def kept_reactions(folder: str, cuts: int = 64) -> Kept:
    return Kept(folder, state.REACTION_KEY, "ReactionAdd", "ReactionRemove", cuts)


def versions(spark: SparkSession, kept: Kept) -> DataFrame:
    """Every version with the path of each cut; no rows before the first."""
    try:
        return spark.read.schema(VERSION).parquet(f"{kept.folder}/versions")
    except AnalysisException:
        return spark.createDataFrame([], VERSION)


def _current(spark: SparkSession, kept: Kept) -> tuple[int, dict[int, str]]:
    """Number of the newest version and its paths: a row for each cut."""
    listed = versions(spark, kept)
    newest = listed.agg(F.max("version")).first()[0]
    if newest is None:
        return 0, {}
    return newest, {r["cut"]: r["path"] for r in listed.filter(F.col("version") == newest).collect()}


def _newest(rows: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Rows at the newest second of their key, each message once."""
    last = state.latest_seconds(rows, key)
    return rows.join(last, [*key, "Timestamp"], "left_semi").dropDuplicates([*key, "Timestamp", "Hash"])


def fold(batch: DataFrame, kept: Kept) -> None:
    """Fold some messages into the state and switch to the new version."""
    spark = batch.sparkSession
    cut = F.pmod(F.xxhash64(*kept.key), F.lit(kept.cuts)).alias("_cut")
    events = (
        batch.filter(F.col("MessageType").isin(kept.add, kept.remove))
        .dropna(subset=[*kept.key, "Timestamp"])
        .select(cut, *batch.columns)
    )
    touched = [r["_cut"] for r in events.select("_cut").distinct().collect()]  # at most kept.cuts
    if not touched:
        return
    version, paths = _current(spark, kept)
    held = [paths[c] for c in touched if c in paths]
    if held:
        before = spark.read.schema(batch.schema).option("recursiveFileLookup", "true").parquet(*held)
        events = events.unionByName(before.select(cut, *batch.columns))
    target = f"{kept.folder}/cuts/{version + 1}-{uuid4().hex}"
    _newest(events, kept.key).hint("rebalance", "_cut").write.partitionBy("_cut").parquet(target)
    now = paths | {c: f"{target}/_cut={c}" for c in touched}
    rows = [(version + 1, c, p) for c, p in sorted(now.items())]
    spark.createDataFrame(rows, VERSION).coalesce(1).write.mode("append").parquet(f"{kept.folder}/versions")


def live(spark: SparkSession, kept: Kept, schema) -> DataFrame:
    """The current state: adds at the newest second of their key, as ``state.live`` gives them."""
    _, paths = _current(spark, kept)
    if not paths:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths.values())
    return rows.filter(F.col("MessageType") == kept.add)


def keep_up(
    messages: DataFrame, kept: Kept, position: str, every_ms: int | None = None,
    after: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Fold each micro-batch of a stream of flat messages; ``after`` is called behind it."""

    def consume(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            fold(batch, kept)
            if after is not None:
                after(batch, number)
        finally:
            batch.unpersist()

    writer = messages.writeStream.option("checkpointLocation", position).foreachBatch(consume)
    if every_ms is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{every_ms} milliseconds").start()
