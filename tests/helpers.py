"""Small flat frames."""

from socialog.sources import schemas


def flat(spark, kind, rows):
    """Flat table of one kind; fields not given take their blank value."""
    schema = schemas.FLAT[kind]
    blank = {f.name: 0 if f.dataType.typeName() == "long" else "" for f in schema.fields}
    return spark.createDataFrame([tuple({**blank, **row}.values()) for row in rows], schema)


def hashes(df):
    return sorted(r["Hash"] for r in df.select("Hash").collect())


def link(fid, target, at, add=True, digest="", kind="follow"):
    return {
        "Fid": fid,
        "TargetFid": target,
        "Timestamp": at,
        "MessageType": "LinkAdd" if add else "LinkRemove",
        "LinkType": kind,
        "Hash": digest,
    }
