"""Tables bucketed by a join key: joins without a shuffle, lookups of one bucket.

Adds, removes and answers are stored once by the hash they are joined on, with the same
number of buckets; every later join of them is local. Hashes spread evenly. A post that
very many removes or answers name is one bucket's worth of work: removes are folded to
one row a hash when they are stored, answers to one post are read by one task.
Where that matters, ``graph.replies`` shuffles and may split.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from socialog.functions import codec

BUCKETS = 64


def store(df: DataFrame, path: str, by: str, buckets: int = BUCKETS) -> DataFrame:
    """Store ``df`` below ``path`` in buckets of ``by``, one file each, and read the table."""
    spark = df.sparkSession
    name = f"bucketed_{uuid4().hex}"
    (
        df.repartition(buckets, by)
        .write.bucketBy(buckets, by)
        .sortBy(by)
        .option("path", path)
        .saveAsTable(name)
    )
    return spark.table(name)


def reopen(spark: SparkSession, path: str, by: str, buckets: int, ddl: str) -> DataFrame:
    """A stored table in a session that doesn't know it."""
    name = f"bucketed_{uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} ({ddl}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
        f"INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def store_casts(log: DataFrame, folder: str, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Added casts by hash, removed hashes, and answers by the hash of their parent."""
    adds = log.filter(F.col("MessageType") == "CastAdd")
    removed = log.filter(F.col("MessageType") == "CastRemove").select(F.col("TargetHash").alias("Hash")).distinct()
    parent = codec.parse_cast_id(F.col("ParentCastId"))
    answers = adds.filter(F.col("ParentCastId") != "").select(
        "Fid", "Hash", "Timestamp", parent["fid"].alias("ParentFid"), parent["hash"].alias("ParentHash")
    )
    return (
        store(adds, f"{folder}/adds", "Hash", buckets),
        store(removed, f"{folder}/removed", "Hash", buckets),
        store(answers, f"{folder}/answers", "ParentHash", buckets),
    )


def live_casts(adds: DataFrame, removed: DataFrame) -> DataFrame:
    """As ``state.live_casts``, bucket by bucket."""
    return adds.join(removed, "Hash", "left_anti").select(*adds.columns)


def replies(answers: DataFrame, casts: DataFrame, removed: DataFrame) -> DataFrame:
    """Live answers with their live parent where it is known, as ``graph.replies``.

    ``casts`` are the live casts of ``live_casts``. The join with parents is by hash and
    stays in its bucket; what moves are the answers' own hashes, to drop removed ones.
    """
    parents = casts.select(
        F.col("Hash").alias("ParentHash"), F.col("Fid").alias("_fid"), F.col("Timestamp").alias("ParentTimestamp")
    ).distinct()
    # The user is compared behind the join: as a second key it would ask for a shuffle by both.
    same = (answers["ParentHash"] == parents["ParentHash"]) & (F.col("ParentFid") - F.col("_fid") == 0)
    joined = answers.join(parents, same, "left").drop(parents["ParentHash"])
    return joined.join(removed, "Hash", "left_anti").select(
        "Fid", "Hash", "Timestamp", "ParentFid", "ParentHash", "ParentTimestamp",
        (F.col("Timestamp") - F.col("ParentTimestamp")).alias("DelaySeconds"),
    )


def casts_by_hash(adds: DataFrame, digest: str) -> DataFrame:
    """Reads one bucket."""
    return adds.filter(F.col("Hash") == digest)
