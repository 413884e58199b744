"""Queue sink for high rates: small batches made durable at once, files rolled by size.

A batch is written aside and then committed by one row that names its folder, its rows
and the position it reaches. Readers see committed batches alone, so a task or driver
lost in between leaves nothing, and a batch that runs again is seen once. When the
batches since the last roll hold ``roll_rows`` rows they are rewritten in order as files of
that size and one more commit row replaces them; a queue then has a file for each
``roll_rows`` rows and the few of the newest batches, however short the batches are.
``drop_rolled`` deletes batches that a roll has replaced.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from socialog.streaming.delivery import BATCH_MILLIS, _trigger

ROLL_ROWS = 1_000_000
ROWS = "event_id bigint, value string, queue string"
COMMITS = "kind string, batch long, path string, rows long, event_id long"
BATCH, ROLL = "batch", "roll"


def commits(spark: SparkSession, folder: str) -> DataFrame:
    try:
        return spark.read.schema(COMMITS).parquet(f"{folder}/commits")
    except AnalysisException:
        return spark.createDataFrame([], COMMITS)


def _commit(spark: SparkSession, folder: str, *row) -> None:
    spark.createDataFrame([row], COMMITS).coalesce(1).write.mode("append").parquet(f"{folder}/commits")


def _in_use(spark: SparkSession, folder: str) -> tuple[list, list]:
    """Commit rows of the rolls, and of the batches behind the last roll; each batch once."""
    found = commits(spark, folder).orderBy("batch", "path").collect()
    rolls = [r for r in found if r["kind"] == ROLL]
    rolled = max((r["batch"] for r in rolls), default=-1)
    return rolls, [r for r in found if r["kind"] == BATCH and r["batch"] > rolled]


def _stored(spark: SparkSession, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], ROWS)
    return spark.read.schema(ROWS).option("recursiveFileLookup", "true").parquet(*paths)


def write_batch(rows: DataFrame, batch: int, folder: str, roll_rows: int = ROLL_ROWS) -> None:
    """Write a batch aside and commit it; roll when it is time. A committed batch is left as it is."""
    spark = rows.sparkSession
    rolls, behind = _in_use(spark, folder)
    if batch <= max([r["batch"] for r in [*rolls, *behind]], default=-1):
        return
    path = f"{folder}/batches/{batch}-{uuid4().hex}"
    rows.select("event_id", "value", "queue").hint("rebalance").write.parquet(path)  # few files a batch
    n, last = spark.read.schema(ROWS).parquet(path).agg(F.count(F.lit(1)), F.max("event_id")).first()
    _commit(spark, folder, BATCH, batch, path, n, last)
    if n + sum(r["rows"] for r in behind) >= roll_rows:
        roll(spark, folder, roll_rows)


def roll(spark: SparkSession, folder: str, roll_rows: int = ROLL_ROWS) -> None:
    """Rewrite the batches behind the last roll, in order of queue and event, and commit that."""
    _, behind = _in_use(spark, folder)
    if not behind:
        return
    n = sum(r["rows"] for r in behind)
    path = f"{folder}/rolled/{behind[-1]['batch']}-{uuid4().hex}"
    (
        _stored(spark, [r["path"] for r in behind])
        .repartitionByRange(max(1, -(-n // roll_rows)), "queue", "event_id")
        .sortWithinPartitions("queue", "event_id")
        .write.parquet(path)
    )
    last = max((r["event_id"] for r in behind if r["event_id"] is not None), default=None)
    _commit(spark, folder, ROLL, behind[-1]["batch"], path, n, last)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of all committed batches, each once."""
    rolls, behind = _in_use(spark, folder)
    return _stored(spark, [r["path"] for r in [*rolls, *behind]])


def position(spark: SparkSession, folder: str) -> int | None:
    """Highest event id that is committed; reads commit rows alone."""
    return commits(spark, folder).agg(F.max("event_id")).first()[0]


def drop_rolled(spark: SparkSession, folder: str) -> int:
    """Delete the folders of batches that a roll replaced; call it when no reader is on an old view."""
    rolls, _ = _in_use(spark, folder)
    rolled = max((r["batch"] for r in rolls), default=-1)
    old = [r["path"] for r in commits(spark, folder).filter(F.col("kind") == BATCH).collect() if r["batch"] <= rolled]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    dropped = 0
    for path in old:
        place = hadoop.Path(path)
        dropped += bool(place.getFileSystem(conf).delete(place, True))
    return dropped


def deliver(
    rows: DataFrame, folder: str, checkpoint: str, every_ms: int | None = BATCH_MILLIS, roll_rows: int = ROLL_ROWS
) -> StreamingQuery:
    """Stream queue rows into the sink."""
    writer = rows.writeStream.option("checkpointLocation", checkpoint)
    consume = lambda batch, number: write_batch(batch, number, folder, roll_rows)
    return _trigger(writer.foreachBatch(consume), every_ms).start()
