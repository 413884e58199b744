"""Batch sinks: tuned Parquet, even parts, compaction, CSV, write statistics."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from socialog.session import stored_bytes


@dataclass(frozen=True)
class WriteProfile:
    row_group_rows: int
    page_bytes: int
    batch_rows: int
    compression: str = "snappy"
    dictionary: bool = True


FILE_BYTES = 512 * 1024 * 1024

# The three tuning profiles.
PROFILES = {
    "optimized": WriteProfile(50_000, 8192, 25_000),
    "high_throughput": WriteProfile(100_000, 8192, 25_000),
    "small": WriteProfile(10_000, 4096, 5_000),
}


def export_zstd(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One table as ZSTD Parquet: a folder of parts, written by all executors."""
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def write_tuned(
    df: DataFrame,
    path: str,
    profile: str = "optimized",
    split_batches: bool = False,
    mode: str = "errorifexists",
) -> None:
    """Parquet with the options of a named profile.

    ``split_batches`` also starts a new file after each ``batch_rows`` rows.
    It is off by default: at 100 TB it would make millions of tiny files.
    """
    p = PROFILES[profile]
    writer = (
        df.write.mode(mode)
        .option("compression", p.compression)
        .option("parquet.block.row.count.limit", p.row_group_rows)
        .option("parquet.page.size", p.page_bytes)
        .option("parquet.enable.dictionary", str(p.dictionary).lower())
    )
    if split_batches:
        writer = writer.option("maxRecordsPerFile", p.batch_rows)
    writer.parquet(path)


def write_parts(df: DataFrame, path: str, parts: int, profile: str = "high_throughput") -> None:
    """Spread the rows evenly (round robin) over ``parts`` files."""
    write_tuned(df.repartition(parts), path, profile)


def parts_for(spark: SparkSession, source: str, file_bytes: int = FILE_BYTES) -> int:
    """How many files of about ``file_bytes`` the data below ``source`` fills."""
    return max(1, -(-stored_bytes(spark, source) // file_bytes))


def compact(spark: SparkSession, source: str, target: str, parts: int | None = None) -> None:
    """Rewrite many small Parquet files as ``parts`` larger ones in a new folder.

    Without ``parts`` the number follows from the bytes there are.
    """
    parts = parts or parts_for(spark, source)
    spark.read.parquet(source).repartition(parts).write.option("compression", "zstd").parquet(target)


def clustered(df: DataFrame, *keys: Column | str) -> DataFrame:
    """Range-partition and sort by ``keys`` for the write that follows.

    Row groups then hold narrow key ranges, so a lookup by id or a time filter
    skips most of them. Lead with the lookup key and add columns that split a
    hot value, such as ``("Fid", "Timestamp")``.
    """
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_lookup(
    df: DataFrame,
    path: str,
    columns: Iterable[str],
    row_group: int = 100_000,
    mode: str = "errorifexists",
) -> None:
    """Parquet with a Bloom filter for each of ``columns`` in every row group.

    For lookups by hash, whose smallest and largest value skip nothing. A filter is
    sized for all rows of its group to differ, about 1.2 bytes a row at one false
    hit in a hundred; hashes don't repeat, so they get no dictionary.
    """
    writer = df.write.mode(mode).option("parquet.block.row.count.limit", row_group)
    for column in columns:
        writer = (
            writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
            .option(f"parquet.bloom.filter.expected.ndv#{column}", row_group)
            .option(f"parquet.bloom.filter.fpp#{column}", "0.01")
            .option(f"parquet.enable.dictionary#{column}", "false")
        )
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV parts without a header line."""
    df.write.mode(mode).option("header", "false").csv(path)


def logical_bytes(schema: T.StructType) -> Column:
    """Plain size of a row: text and binary length, 8 bytes for other scalars."""
    total = F.lit(0).cast("long")
    for field in schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(field.name), F.lit(0))
        else:
            total = total + F.lit(8)
    return total


def write_statistics(spark: SparkSession, path: str) -> DataFrame:
    """Rows, file bytes and compression ratio of every file below ``path``."""
    df = spark.read.parquet(path)
    return (
        df.select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_bytes"),
            logical_bytes(df.schema).alias("plain_bytes"),
        )
        .groupBy("file_path")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.max("file_bytes").alias("file_bytes"),
            F.sum("plain_bytes").alias("plain_bytes"),
        )
        .withColumn("compression_ratio", F.col("plain_bytes") / F.col("file_bytes"))
    )


def sink_totals(batches: DataFrame) -> DataFrame:
    """Batches, rows, bytes, average and peak flush time of a batch log; 0 without any."""

    def known(measure: Column, name: str) -> Column:
        return F.coalesce(measure, F.lit(0)).alias(name)

    return batches.agg(
        F.count(F.lit(1)).alias("batches"),
        known(F.sum("rows"), "rows"),
        known(F.sum("bytes"), "bytes"),
        known(F.sum("flush_ms"), "total_flush_ms"),
        known(F.avg("flush_ms"), "avg_flush_ms"),
        known(F.max("flush_ms"), "peak_flush_ms"),
    )
