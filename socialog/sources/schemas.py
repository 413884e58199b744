"""Declared schemas: flat tables, nested messages, event stream."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TEXT, _NUMBER, _BYTES = T.StringType(), T.LongType(), T.BinaryType()


def _record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _flat(**fields: T.DataType) -> T.StructType:
    return _record(
        Fid=_NUMBER,
        MessageType=_TEXT,
        Timestamp=_NUMBER,
        Hash=_TEXT,
        SignatureScheme=_TEXT,
        Signature=_TEXT,
        Signer=_TEXT,
        **fields,
    )


CASTS = _flat(
    Text=_TEXT,
    Mentions=_TEXT,
    ParentCastId=_TEXT,
    ParentUrl=_TEXT,
    Embeds=_TEXT,
    TargetHash=_TEXT,
)
REACTIONS = _flat(ReactionType=_TEXT, TargetCastId=_TEXT, TargetUrl=_TEXT)
LINKS = _flat(LinkType=_TEXT, TargetFid=_NUMBER, DisplayTimestamp=_NUMBER)
PROFILES = _flat(UserDataType=_TEXT, Value=_TEXT, UserDataTypeReadable=_TEXT)
VERIFICATIONS = _flat(Address=_TEXT, Protocol=_TEXT)
LINK_STATES = _flat(LinkType=_TEXT, TargetFids=_TEXT)

FLAT = {
    "casts": CASTS,
    "reactions": REACTIONS,
    "links": LINKS,
    "profiles": PROFILES,
    "verifications": VERIFICATIONS,
    "link_states": LINK_STATES,
}

# Message types that belong to each table.
MESSAGE_TYPES = {
    "casts": ("CastAdd", "CastRemove"),
    "reactions": ("ReactionAdd", "ReactionRemove"),
    "links": ("LinkAdd", "LinkRemove", "LinkCompactState"),
    "profiles": ("UserDataAdd",),
    "verifications": ("VerificationAddEthAddress", "VerificationRemove"),
    "link_states": ("LinkCompactState",),
}

CAST_ID = _record(fid=_NUMBER, hash=_BYTES)
EMBED = _record(url=_TEXT, cast_id=CAST_ID)

# Bodies of a message; at most one is set.
BODIES = {
    "cast_add_body": _record(
        text=_TEXT,
        mentions=T.ArrayType(_NUMBER),
        mentions_positions=T.ArrayType(_NUMBER),
        parent_cast_id=CAST_ID,
        parent_url=_TEXT,
        embeds=T.ArrayType(EMBED),
    ),
    "cast_remove_body": _record(target_hash=_BYTES),
    "reaction_body": _record(type=_TEXT, target_cast_id=CAST_ID, target_url=_TEXT),
    "link_body": _record(type=_TEXT, target_fid=_NUMBER, displayTimestamp=_NUMBER),
    "user_data_body": _record(type=_TEXT, value=_TEXT),
    "verification_add_address_body": _record(address=_BYTES, protocol=_TEXT),
    "verification_remove_body": _record(address=_BYTES, protocol=_TEXT),
    "link_compact_state_body": _record(type=_TEXT, target_fids=T.ArrayType(_NUMBER)),
}

MESSAGE = _record(
    data=_record(type=_TEXT, fid=_NUMBER, timestamp=_NUMBER, network=_TEXT, **BODIES),
    hash=_BYTES,
    hash_scheme=_TEXT,
    signature=_BYTES,
    signature_scheme=_TEXT,
    signer=_BYTES,
)
EVENT = _record(
    id=_NUMBER,
    type=_TEXT,
    timestamp=_NUMBER,
    shard_index=_NUMBER,
    merge_message_body=_record(message=MESSAGE),
    processed_at=_NUMBER,
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; missing ones become NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def shaped(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """A column in the type ``want``, fields taken by name at every depth; missing ones are NULL."""
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        given = {f.name: f.dataType for f in have.fields}
        fields = [
            (shaped(column[f.name], given[f.name], f.dataType) if f.name in given else F.lit(None).cast(f.dataType))
            .alias(f.name)
            for f in want.fields
        ]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(column, lambda x: shaped(x, have.elementType, want.elementType))
    return column.cast(want)


def build(schema: T.StructType, values: dict[str, Column]) -> list[Column]:
    """One typed column per field, NULL where ``values`` has none."""
    return [
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ]


def schema_of_row(sample: dict) -> T.StructType:
    """Schema guessed from one row; every type not listed becomes a string."""
    kinds = (
        (bool, T.BooleanType()),
        (int, T.LongType()),
        (float, T.DoubleType()),
        (dt.datetime, T.TimestampType()),
        ((bytes, bytearray), T.BinaryType()),
    )

    def kind(value) -> T.DataType:
        return next((t for c, t in kinds if isinstance(value, c)), T.StringType())

    return T.StructType([T.StructField(name, kind(value)) for name, value in sample.items()])
