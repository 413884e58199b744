"""Event pages: a stored event log that is read from an event id on.

A page is a Parquet file with events of one shard in id order; ``_pages`` below the
folder lists each page with its shard, first and last id and rows. Pages are listed
after they are written, so readers never see half an append.

``event_pages`` is a data source over them. As a stream its offset is the last id of
each shard: a stream can begin and end anywhere inside a page, and a restart reads on
behind the last id that was delivered, whatever files have come or gone. Ids of a shard
must grow from append to append; ids below a stream's offset are not seen by it.
Only pages and row groups that can hold a wanted id, type and shard are read, and only the
top-level columns of the schema asked for; each page is a task. The driver sees the
list of pages, never an event.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from uuid import uuid4

from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from socialog.sources import schemas

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors don't need this package

PAGE_ROWS = 500_000
LISTED = "path string, shard long, first long, last long, rows long"
EVENT_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.EVENT.fields)


# Writing


def append_pages(events: DataFrame, folder: str, page_rows: int = PAGE_ROWS) -> None:
    """Store events as pages and list them. Events without a shard are in shard -1."""
    spark = events.sparkSession
    target = f"{folder}/pages/{uuid4().hex}"
    shard = F.coalesce(F.col("shard_index"), F.lit(-1))
    (
        events.withColumn("_shard", shard)
        .repartitionByRange("_shard", "id")
        .sortWithinPartitions("_shard", "id")
        .write.option("maxRecordsPerFile", page_rows)
        .partitionBy("_shard")
        .parquet(target)
    )
    try:
        stored = spark.read.option("basePath", target).parquet(f"{target}/_shard=*")
    except AnalysisException:  # no events, no files
        return
    listed = stored.groupBy(
        F.col("_metadata.file_path").alias("path"), F.col("_shard").cast("long").alias("shard")
    ).agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("rows"))
    listed.coalesce(1).write.mode("append").parquet(f"{folder}/_pages")


def listed_pages(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(LISTED).parquet(f"{folder}/_pages")


# Reading


@dataclass
class Page:
    path: str
    shard: int
    first: int
    last: int
    rows: int


@dataclass
class Stretch(InputPartition):
    """What one task reads: events of a page with ``after < id <= upto``."""

    path: str
    after: int
    upto: int
    types: list[str]
    reverse: bool = False


def _opened(path: str):
    """File system of a path and the path on it."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))


def _pages(folder: str, shard: int | None) -> list[Page]:
    """The listed pages in order of shard and id, read by the driver."""
    import pyarrow.dataset as ds

    files, place = _opened(f"{folder}/_pages")
    table = ds.dataset(place, format="parquet", filesystem=files, exclude_invalid_files=False)
    found = [Page(**row) for row in table.to_table(columns=["path", "shard", "first", "last", "rows"]).to_pylist()]
    return sorted((p for p in found if shard is None or p.shard == shard), key=lambda p: (p.shard, p.first, p.path))


def _rows(stretch: Stretch, schema: StructType) -> Iterator:
    """Arrow batches of a stretch in id order."""
    import pyarrow as pa
    import pyarrow.dataset as ds
    from pyspark.sql.pandas.types import to_arrow_schema

    files, place = _opened(stretch.path)
    wanted = (ds.field("id") > stretch.after) & (ds.field("id") <= stretch.upto)
    if stretch.types:
        wanted &= ds.field("type").isin(stretch.types)
    page = ds.dataset(place, format="parquet", filesystem=files)
    target = to_arrow_schema(schema)
    batches = page.scanner(columns=target.names, filter=wanted).to_batches()
    if stretch.reverse:  # a page is bounded by its rows
        whole = pa.Table.from_batches(batches, page.scanner(columns=target.names).projected_schema)
        batches = whole.take(pa.array(range(len(whole) - 1, -1, -1))).to_batches()
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name).cast(f.type) for f in target], schema=target
            )


class _Options:
    """Options of the source; names are not case-sensitive.

    ``path``; ``from_id`` (events behind it; default -1; for streams also ``newest``);
    ``stop_id`` (the last id to read); ``types`` (event types, separated by commas);
    ``shard``; ``reverse`` (batch only: highest ids first); ``max_rows`` (stream only: about as many
    rows a batch, whole pages, at least one page a shard with news); ``position`` (stream only: the
    checkpoint folder, which lets a restarted stream keep to ``max_rows`` from its first
    batch on; without it that batch holds all that is there).
    """

    def __init__(self, options):
        self.folder = options["path"].rstrip("/")
        self.start = options.get("from_id", "-1")
        stop = options.get("stop_id")
        self.stop = None if stop is None else int(stop)
        self.types = [t for t in options.get("types", "").split(",") if t]
        shard = options.get("shard")
        self.shard = None if shard is None else int(shard)
        self.reverse = options.get("reverse", "false").lower() == "true"
        most = options.get("max_rows")
        self.max_rows = None if most is None else int(most)
        self.position = options.get("position")

    def pages(self) -> list[Page]:
        return _pages(self.folder, self.shard)

    def upto(self, last: int) -> int:
        return last if self.stop is None else min(last, self.stop)


class _Batch(DataSourceReader):
    def __init__(self, options: _Options, schema: StructType):
        self.options, self.schema = options, schema

    def partitions(self) -> list[Stretch]:
        o, after = self.options, int(self.options.start)
        found = [
            Stretch(p.path, after, o.upto(p.last), o.types, o.reverse)
            for p in o.pages()
            if p.last > after and (o.stop is None or p.first <= o.stop)
        ]
        return found[::-1] if o.reverse else found

    def read(self, partition: Stretch | None) -> Iterator:
        return iter(()) if partition is None else _rows(partition, self.schema)  # None: there are no partitions


class _Stream(DataSourceStreamReader):
    def __init__(self, options: _Options, schema: StructType):
        self.options, self.schema = options, schema
        self.at: dict[str, int] | None = None
        self.begin: dict[str, int] | None = None
        if options.position is not None:
            self.at = last_offset(options.position) or self.initialOffset()

    def initialOffset(self) -> dict:
        o = self.options
        if self.begin is None:
            self.begin = {}
            for page in o.pages():
                first = page.last if o.start == "newest" else int(o.start)
                self.begin[str(page.shard)] = max(first, self.begin.get(str(page.shard), first))
        return self.begin

    def _from(self, start: dict, shard: int) -> int:
        """Where a shard goes on; one that came later is read from its beginning."""
        first = -1 if self.options.start == "newest" else int(self.options.start)
        return start.get(str(shard), first)

    def latestOffset(self) -> dict:
        o = self.options
        known = self.at if self.at is not None else self.initialOffset()
        end = dict(known)
        news = [p for p in o.pages() if o.upto(p.last) > self._from(known, p.shard)]
        share = None
        if o.max_rows is not None and self.at is not None:
            share = max(1, o.max_rows // max(1, len({p.shard for p in news})))
        taken: dict[int, int] = {}
        for p in news:
            had = taken.get(p.shard, 0)
            if share is not None and had and had + p.rows > share:
                taken[p.shard] = share  # pages behind this one wait too
                continue
            taken[p.shard] = had + p.rows
            end[str(p.shard)] = max(o.upto(p.last), end.get(str(p.shard), -1))
        return end

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        self.at = end
        found = []
        for p in self.options.pages():
            after, upto = self._from(start, p.shard), end.get(str(p.shard), -1)
            if after < upto and p.last > after and p.first <= upto:
                found.append(Stretch(p.path, after, upto, self.options.types))
        return found

    def read(self, partition: Stretch) -> Iterator:
        return _rows(partition, self.schema)


def last_offset(position: str, source: int = 0) -> dict | None:
    """The offset up to which a checkpoint folder has committed batches, None without any."""
    from pyarrow import fs

    files, place = _opened(position)

    def numbers(kind: str) -> list[int]:
        selector = fs.FileSelector(f"{place}/{kind}", allow_not_found=True)
        return [int(f.base_name) for f in files.get_file_info(selector) if f.base_name.isdigit()]

    done = numbers("commits")
    if not done:
        return None
    with files.open_input_stream(f"{place}/offsets/{max(done)}") as file:
        lines = file.read().decode().splitlines()
    return json.loads(lines[2 + source])  # behind version and metadata: one line a source


class EventPages(DataSource):
    """``spark.read`` and ``spark.readStream`` ``.format("event_pages")``; options: ``_Options``."""

    @classmethod
    def name(cls) -> str:
        return "event_pages"

    def schema(self) -> str:
        return EVENT_DDL

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Batch(_Options(self.options), schema)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Stream(_Options(self.options), schema)


def _told(reader, folder: str, columns: Iterable[str], options: dict):
    named = {k: (",".join(v) if k == "types" else str(v)) for k, v in options.items() if v is not None}
    columns = list(columns)
    reader = reader.format("event_pages").options(**named)
    if columns:
        reader = reader.schema(StructType([schemas.EVENT[c] for c in columns]))
    return reader.load(folder)


def read_pages(spark: SparkSession, folder: str, columns: Iterable[str] = (), **options) -> DataFrame:
    """Stored events as a batch, in order of shard and id (``reverse``: the other way round)."""
    spark.dataSource.register(EventPages)
    return _told(spark.read, folder, columns, options)


def stream_pages(spark: SparkSession, folder: str, columns: Iterable[str] = (), **options) -> DataFrame:
    """Stored events as a stream from an event id on."""
    spark.dataSource.register(EventPages)
    return _told(spark.readStream, folder, columns, options)
