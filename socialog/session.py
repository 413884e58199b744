"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PART_BYTES = 200 * 1024 * 1024
UNPACKED = 3  # rows in a shuffle take about this many times their Parquet bytes

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(cores: int | str = "*", **extra: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("socialog")
    options = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        **extra,
    }
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is used only where the setting is missing and Spark
    runs in local mode.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


@lru_cache(maxsize=1)
def _local_folder() -> str:
    """A folder of this process in local mode; it goes when the process ends."""
    folder = tempfile.mkdtemp(prefix="socialog-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored_bytes(spark: SparkSession, *folders: str) -> int:
    """Bytes of the Parquet files below ``folders``; lists them and reads none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    total = files.load(list(folders)).agg(F.coalesce(F.sum("length"), F.lit(0)))
    return total.first()[0]


def size_shuffles(spark: SparkSession, *folders: str, part_bytes: int = PART_BYTES) -> int:
    """Set the shuffle partitions so that one holds about ``part_bytes`` of the input.

    Call it before a run over ``folders``. Too many does no harm: adaptive
    execution merges small ones.
    """
    wanted = -(-stored_bytes(spark, *folders) * UNPACKED // part_bytes)
    parts = max(wanted, spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    return parts


@contextmanager
def sized_shuffles(spark: SparkSession, *folders: str) -> Iterator[int]:
    """``size_shuffles`` for the length of a run; the setting is put back after it."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        yield size_shuffles(spark, *folders)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SCRATCH: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())  # paths by open scope


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a table of ours, in whatever store it lies."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables ``written`` within are deleted at the end.

    What leaves the block must come from tables written with ``keep``, which belong to
    the block around it, if there is one.
    """
    paths: list[str] = []
    before = _SCRATCH.set((*_SCRATCH.get(), paths))
    try:
        yield
    finally:
        _SCRATCH.reset(before)
        for path in paths:
            remove(spark, path)


def written(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Cuts the lineage at a table that outlives lost executors; the shuffles that led to
    it are dropped once it stands.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    scopes = _SCRATCH.get()
    if keep:
        scopes = scopes[:-1]
    if scopes:
        scopes[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)
