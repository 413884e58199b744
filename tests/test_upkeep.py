"""Kept state, compact link messages, verification messages, protobuf names."""

import random

import pytest
from conftest import DATA
from helpers import flat, hashes, link
from pyspark.sql import functions as F

from socialog.operators import normalize, state
from socialog.plans import fixtures as fx
from socialog.plans.messages import _as_protobuf_names
from socialog.sources import schemas, tables
from socialog.streaming import upkeep


def log(count, seed):
    rng = random.Random(seed)
    return [link(rng.randrange(4), rng.randrange(3), rng.randrange(6), rng.random() < 0.6, f"0x{i}") for i in range(count)]


@pytest.mark.parametrize("seed", range(3))
def test_any_order_and_batching_keeps_the_same_state(spark, tmp_path, seed):
    rows = log(60, seed)
    wanted = hashes(state.live_links(flat(spark, "links", rows)))
    random.Random(seed).shuffle(rows)
    kept = upkeep.kept_links(str(tmp_path), cuts=3)
    parts = [rows[:7], rows[7:20], rows[:20], rows[20:], rows[7:20]]
    for part in parts:  # one batch comes twice, another overlaps
        upkeep.fold(flat(spark, "links", part), kept)
    assert hashes(upkeep.live(spark, kept, schemas.LINKS)) == wanted


def test_a_late_remove_is_remembered(spark, tmp_path):
    kept = upkeep.kept_links(str(tmp_path), cuts=2)
    for row in (link(1, 2, 5, add=False, digest="0xa"), link(1, 2, 4, digest="0xb"), link(1, 2, 5, digest="0xc")):
        upkeep.fold(flat(spark, "links", [row]), kept)
    assert hashes(upkeep.live(spark, kept, schemas.LINKS)) == ["0xc"]  # an add tied with a remove stays


def test_only_touched_cuts_are_written(spark, tmp_path):
    kept = upkeep.kept_links(str(tmp_path), cuts=16)
    upkeep.fold(flat(spark, "links", log(80, 1)), kept)
    upkeep.fold(flat(spark, "links", [link(1, 2, 9, digest="0xnew")]), kept)
    upkeep.fold(flat(spark, "links", [{"MessageType": "LinkCompactState", "Fid": 1}]), kept)  # of no kind
    upkeep.fold(flat(spark, "links", log(80, 1)).limit(0), kept)
    paths = {v: {} for v in (1, 2)}
    for r in upkeep.versions(spark, kept).collect():
        paths[r["version"]][r["cut"]] = r["path"]
    assert sum(paths[1].get(c) != p for c, p in paths[2].items()) == 1


def test_a_fold_that_stops_before_the_switch_is_not_seen(spark, tmp_path, monkeypatch):
    kept = upkeep.kept_links(str(tmp_path), cuts=2)
    upkeep.fold(flat(spark, "links", [link(1, 2, 1, digest="0xa")]), kept)

    class Lost(Exception):
        pass

    def stop(*_, **__):
        raise Lost

    monkeypatch.setattr(type(spark), "createDataFrame", stop)
    with pytest.raises(Lost):
        upkeep.fold(spark.read.schema(schemas.LINKS).parquet(_stored(spark, tmp_path)), kept)
    monkeypatch.undo()
    assert hashes(upkeep.live(spark, kept, schemas.LINKS)) == ["0xa"]
    upkeep.fold(spark.read.schema(schemas.LINKS).parquet(_stored(spark, tmp_path)), kept)
    assert hashes(upkeep.live(spark, kept, schemas.LINKS)) == []


def _stored(spark, tmp_path):
    path = tmp_path / "remove"
    if not path.exists():
        row = ",".join(f"{'2' if f.name in ('Timestamp', 'TargetFid') else '1'} AS {f.name}" if f.dataType.typeName() == "long"
                       else f"'{ {'MessageType': 'LinkRemove', 'LinkType': 'follow'}.get(f.name, '0xr') }' AS {f.name}"
                       for f in schemas.LINKS.fields)
        spark.sql(f"SELECT {row}").write.parquet(str(path))
    return str(path)


def test_an_empty_state(spark, tmp_path):
    assert upkeep.live(spark, upkeep.kept_reactions(str(tmp_path)), schemas.REACTIONS).count() == 0


# Compact messages


def compact(fid, at, targets, digest="0xk", kind="follow"):
    return {"Fid": fid, "MessageType": "LinkCompactState", "Timestamp": at, "Hash": digest, "LinkType": kind, "TargetFids": ",".join(map(str, targets))}


def compacts(spark, rows):
    schema = schemas.LINK_STATES
    blank = {f.name: 0 if f.dataType.typeName() == "long" else "" for f in schema.fields}
    return spark.createDataFrame([tuple({**blank, **r}.values()) for r in rows], schema)


def targets(df):
    return sorted((r["Fid"], r["TargetFid"], r["Timestamp"]) for r in df.collect())


def test_a_compact_message_replaces_all_up_to_its_second(spark):
    rows = [link(1, t, at, digest=f"0x{t}{at}") for t, at in ((7, 3), (8, 5), (9, 6))]
    rows += [link(1, 4, 7, add=False, digest="0xr"), link(1, 5, 5, add=False, digest="0xs"), link(2, 7, 1, digest="0xo")]
    rows += [link(1, 7, 1, digest="0xb", kind="block")]
    states = [compact(1, 5, [4, 5, 5, 6]), compact(1, 2, [99], "0xold"), compact(1, 5, [], "0xj"), compact(3, 1, [], "0xe")]
    live = state.live_compacted_links(flat(spark, "links", rows), compacts(spark, [*states, states[0]]))
    # 7 and 8 went by the compact message, 4 by the remove after it, the remove of 5 at its second does not count
    assert targets(live) == [(1, 5, 5), (1, 6, 5), (1, 7, 1), (1, 9, 6), (2, 7, 1)]


def test_a_log_that_was_compacted_gives_the_same_links(spark):
    rows = flat(spark, "links", log(120, 9))
    early, late = rows.filter("Timestamp < 3"), rows.filter("Timestamp >= 3")
    lists = (
        state.compact_links(state.live_links(early), span=2)
        .groupBy("Fid", "LinkType")
        .agg(F.array_join(F.flatten(F.collect_list("TargetFids")), ",").alias("TargetFids"))
    )
    told = lists.withColumns({"Timestamp": F.lit(2).cast("long"), "Hash": F.lit("0xk"), "MessageType": F.lit("LinkCompactState")})
    live = state.live_compacted_links(late, schemas.conform(told, schemas.LINK_STATES))
    pairs = ["Fid", "TargetFid", "LinkType"]
    assert sorted(live.select(pairs).distinct().collect()) == sorted(state.live_links(rows).select(pairs).distinct().collect())


def test_no_compact_messages(spark):
    rows = flat(spark, "links", log(40, 2))
    assert hashes(state.live_compacted_links(rows, compacts(spark, []))) == hashes(state.live_links(rows))


# Verification messages


def test_a_removed_address_is_nobodys(spark):
    def message(fid, at, address, digest, add=True, protocol="Ethereum"):
        kind = "VerificationAddEthAddress" if add else "VerificationRemove"
        return {"Fid": fid, "MessageType": kind, "Timestamp": at, "Hash": digest, "Address": address, "Protocol": protocol}

    rows = [
        message(1, 1, "0xa", "0x1"), message(1, 2, "0xb", "0x2"), message(1, 3, "0xb", "0x3", add=False),
        message(2, 1, "0xa", "0x4", add=False), message(2, 2, "0xa", "0x5"),
        message(3, 4, "0xd", "0x7"), message(3, 4, "0xc", "0x6"), message(3, 9, "0xe", "0x8", protocol="Solana"),
    ]
    live = state.live_verifications(flat(spark, "verifications", rows))
    found = {r["fid"]: r["address"] for r in state.latest_addresses(state.listed_addresses(live)).collect()}
    assert found == {1: "0xa", 2: "0xa", 3: "0xc"}


# Protobuf names


@pytest.mark.parametrize("name, plain", [
    ("MESSAGE_TYPE_VERIFICATION_ADD_ETH_ADDRESS", "VerificationAddEthAddress"), ("HASH_SCHEME_BLAKE3", "Blake3"),
    ("SIGNATURE_SCHEME_ED25519", "Ed25519"), ("SOCIAL_NETWORK_MAINNET", "Mainnet"), ("follow", "follow"),
    ("REACTION_TYPE_LIKE", "Like"), ("PROTOCOL_ETHEREUM", "Ethereum"), (None, None),
])
def test_plain_names(spark, name, plain):
    row = spark.createDataFrame([(name,)], "name string").select(tables.plain_name(F.col("name")))
    assert row.first()[0] == plain


def test_decoded_messages_have_the_declared_schema(spark):
    given = fx.messages(spark, DATA, "casts")
    decoded = tables.decoded_messages(_as_protobuf_names(given))
    assert [(f.name, f.dataType) for f in decoded.schema.fields] == [(f.name, f.dataType) for f in schemas.MESSAGE.fields]
    assert normalize.flatten_casts(decoded).exceptAll(fx.casts(spark, DATA)).count() == 0
    empty = _as_protobuf_names(given.limit(0))
    assert tables.decoded_messages(empty).count() == 0
    no_data = spark.createDataFrame([(None, None)], "data struct<type:string>, hash binary")
    assert tables.decoded_messages(no_data).first()["data"] is None
