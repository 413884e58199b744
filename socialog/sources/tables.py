"""Reading the log: flat tables, nested messages, event ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from socialog.sources import schemas


def scan_log(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """The Parquet files directly below ``folder`` with the declared schema.

    Sub-folders left behind by writers are not read.
    """
    return spark.read.schema(schemas.FLAT[kind]).parquet(f"{folder}/*.parquet")


def scan_kind(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """The log of one kind in the layout ``<root>/<kind>/<kind>_messages``."""
    return scan_log(spark, f"{root}/{kind}/{kind}_messages", kind)


def scan_messages(spark: SparkSession, path: str, source: str = "parquet") -> DataFrame:
    """Nested messages from Parquet, or from JSON with base64 bytes."""
    return spark.read.format(source).schema(schemas.MESSAGE).load(path)


def scan_events(spark: SparkSession, path: str, source: str = "parquet") -> DataFrame:
    return spark.read.format(source).schema(schemas.EVENT).load(path)


def decode_messages(df: DataFrame, column: str, descriptor: str, name: str = "Message") -> DataFrame:
    """Protobuf bytes to nested messages; needs Spark's protobuf package on the cluster."""
    from pyspark.sql.protobuf.functions import from_protobuf

    return decoded_messages(df.select(from_protobuf(F.col(column), name, descriptor).alias("m")).select("m.*"))


# The prefixes of protobuf's enum names.
_PREFIXES = (
    "MESSAGE_TYPE", "[A-Z]+_NETWORK", "HASH_SCHEME", "SIGNATURE_SCHEME",
    "REACTION_TYPE", "USER_DATA_TYPE", "PROTOCOL",
)
_PREFIXED = f"^({'|'.join(_PREFIXES)})_"


def plain_name(name: Column) -> Column:
    """``MESSAGE_TYPE_CAST_ADD`` as ``CastAdd``; a name without a known prefix stays."""
    words = F.replace(F.regexp_replace(name, _PREFIXED, ""), F.lit("_"), F.lit(" "))
    plain = F.replace(F.initcap(words), F.lit(" "), F.lit(""))
    return F.when(name.rlike(_PREFIXED), plain).otherwise(name)


def decoded_messages(decoded: DataFrame) -> DataFrame:
    """Messages as protobuf decodes them, in the declared schema and with plain type names.

    Fields are taken by name, so those not declared are left out; numbers widen.
    """
    shape = decoded.select(
        *[
            (schemas.shaped(F.col(f.name), decoded.schema[f.name].dataType, f.dataType))
            if f.name in decoded.columns
            else F.lit(None).cast(f.dataType)
            for f in schemas.MESSAGE.fields
        ]
    ).toDF(*schemas.MESSAGE.names)

    def named(body: str, field: str) -> Column:
        column = F.col("data")[body]
        return F.when(column.isNotNull(), column.withField(field, plain_name(column[field])))

    data = F.col("data")
    for field in ("type", "network"):
        data = data.withField(field, plain_name(F.col("data")[field]))
    for body, field in (
        ("reaction_body", "type"),
        ("user_data_body", "type"),
        ("verification_add_address_body", "protocol"),
        ("verification_remove_body", "protocol"),
    ):
        data = data.withField(body, named(body, field))
    return shape.withColumns(
        {
            "data": F.when(F.col("data").isNotNull(), data),
            "hash_scheme": plain_name(F.col("hash_scheme")),
            "signature_scheme": plain_name(F.col("signature_scheme")),
        }
    )


def event_range(
    events: DataFrame,
    start_id: int,
    stop_id: int | None = None,
    size: int | None = None,
    reverse: bool = False,
    shard: int | None = None,
) -> DataFrame:
    """Events with ``start_id <= id <= stop_id`` in id order, at most ``size``."""
    chosen = events.filter(F.col("id") >= start_id)
    if shard is not None:
        chosen = chosen.filter(F.col("shard_index") == shard)
    if stop_id is not None:
        chosen = chosen.filter(F.col("id") <= stop_id)
    order = F.col("id").desc() if reverse else F.col("id").asc()
    chosen = chosen.orderBy(order)
    return chosen if size is None else chosen.limit(size)


def newest(df: DataFrame, column: str) -> DataFrame:
    """The row with the highest value of ``column``."""
    return df.orderBy(F.col(column).desc()).limit(1)


def sweep(log: DataFrame, first: int | Column, last: int | Column = 1) -> DataFrame:
    """Rows of the ids from ``first`` down to ``last``."""
    return log.filter(F.col("Fid").between(last, first))


def union_shards(*shards: DataFrame) -> DataFrame:
    whole, *rest = shards
    for shard in rest:
        whole = whole.unionByName(shard)
    return whole
