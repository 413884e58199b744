"""Compaction that keeps the order: neighbouring small files become files of a target size.

Files are planned by what they hold: their bytes and the range of a key. Files of half
the target or more stay untouched. Small ones that are neighbours in key order are grouped
up to the target, and each group is rewritten, sorted, by one task that reads nothing
else; so no file covers more of the key than its group did, and rows of large files
don't move. A manifest names the files in use; writing its next version is the switch.
Files no version names any more are left for the storage's retention.

Files that hold only NULL keys come first.
"""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from socialog.sources.sinks import FILE_BYTES

MANIFEST = "version long, path string"


@dataclass(frozen=True)
class File:
    path: str
    bytes: int
    low: object
    high: object


def current_files(spark: SparkSession, folder: str) -> list[str] | None:
    """Files of the newest version, None before the first."""
    try:
        listed = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")
    except AnalysisException:
        return None
    newest = listed.agg(F.max("version")).first()[0]
    return [r["path"] for r in listed.filter(F.col("version") == newest).collect()]


def read(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The rows in use: those of the newest version, or of all files directly below ``folder``."""
    files = current_files(spark, folder)
    reader = spark.read.schema(schema)
    return reader.parquet(f"{folder}/*.parquet") if files is None else reader.parquet(*files)


def files_in_use(spark: SparkSession, folder: str, schema: StructType, key: str) -> list[File]:
    """Size and key range of each file; reads the key column alone."""
    found = (
        read(spark, folder, schema)
        .groupBy(F.col("_metadata.file_path").alias("path"))
        .agg(F.max("_metadata.file_size").alias("bytes"), F.min(key).alias("low"), F.max(key).alias("high"))
    )
    return [File(r["path"], r["bytes"], r["low"], r["high"]) for r in found.collect()]  # a row a file


def planned(files: list[File], target: int = FILE_BYTES) -> list[list[File]]:
    """Groups of two or more small neighbours, each of ``target`` bytes at most.

    A large file between two small ones ends a group: its key range is not to be spanned.
    """
    groups: list[list[File]] = []
    group: list[File] = []
    held = 0
    for file in sorted(files, key=lambda f: (f.low is not None, f.low, f.high, f.path)):
        large = 2 * file.bytes >= target
        if large or held + file.bytes > target:
            groups.append(group)
            group, held = [], 0
        if not large:
            group.append(file)
            held += file.bytes
    return [g for g in [*groups, group] if len(g) > 1]


def compact(spark: SparkSession, folder: str, schema: StructType, key: str, target: int = FILE_BYTES) -> int:
    """Rewrite groups of small neighbours; the number of files that were merged."""
    files = files_in_use(spark, folder, schema, key)
    groups = planned(files, target)
    if not groups:
        return 0
    merged = {f.path: k for k, group in enumerate(groups) for f in group}
    plan = spark.createDataFrame(list(merged.items()), "_path string, _group int")
    rows = spark.read.schema(schema).parquet(*merged).select("*", F.col("_metadata.file_path").alias("_path"))
    path = f"{folder}/compacted/{uuid4().hex}"
    (
        rows.join(plan, "_path")
        .drop("_path")
        .repartition(len(groups), "_group")
        .sortWithinPartitions("_group", key)
        .write.option("compression", "zstd")
        .partitionBy("_group")
        .parquet(path)
    )
    written = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path).inputFiles()
    names = [*(f.path for f in files if f.path not in merged), *written]
    before = current_files(spark, folder)
    version = 0
    if before is not None:
        version = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest").agg(F.max("version")).first()[0] + 1
    switched = spark.createDataFrame([(version, name) for name in names], MANIFEST)
    switched.coalesce(1).write.mode("append").parquet(f"{folder}/_manifest")
    return len(merged)
