import random

import pytest
from helpers import flat, hashes, link

from socialog.operators import graph, state

FORMS = [state.live, state.live_ranked, state.live_joined]


@pytest.mark.parametrize("how", FORMS)
@pytest.mark.parametrize(
    "rows, kept",
    [
        ([link(1, 2, 10, True, "a"), link(1, 2, 10, False, "b")], ["a"]),
        ([link(1, 2, 10, True, "a"), link(1, 2, 10, True, "b")], ["a", "b"]),
        ([link(1, 2, 10, True, "a"), link(1, 2, 11, False, "b")], []),
        ([link(1, 2, 12, True, "a"), link(1, 2, 11, False, "b")], ["a"]),
        ([link(1, 2, 10, True, "a"), link(1, 3, 11, False, "b")], ["a"]),
        ([link(1, 2, 10, True, "a"), link(1, 2, 11, False, "b", "block")], ["a"]),
        ([link(1, 2, 10, True, "a"), link(1, 2, 10, True, "a")], ["a", "a"]),
    ],
)
def test_latest_event_wins(spark, how, rows, kept):
    assert hashes(state.live_links(flat(spark, "links", rows), how=how)) == kept


@pytest.mark.parametrize("how", FORMS)
def test_random_log_against_brute_force(spark, how):
    rng = random.Random(17)
    rows = [
        link(rng.randrange(4), rng.randrange(4), rng.randrange(6), rng.random() < 0.6, f"{i:03}")
        for i in range(300)
    ]
    newest = {}
    for r in rows:
        key = (r["Fid"], r["TargetFid"])
        newest[key] = max(newest.get(key, -1), r["Timestamp"])
    want = sorted(
        r["Hash"]
        for r in rows
        if r["MessageType"] == "LinkAdd" and r["Timestamp"] == newest[r["Fid"], r["TargetFid"]]
    )
    assert hashes(state.live_links(flat(spark, "links", rows), how=how)) == want


def url_reaction(at, url, digest):
    return {
        "Fid": 1, "Timestamp": at, "MessageType": "ReactionAdd", "ReactionType": "Like",
        "TargetUrl": url, "Hash": digest,
    }


def test_url_reactions_share_a_key_unless_asked(spark):
    log = flat(spark, "reactions", [url_reaction(1, "u", "a"), url_reaction(2, "v", "b")])
    assert hashes(state.live_reactions(log)) == ["b"]
    assert hashes(state.live_reactions(log, by_url=True)) == ["a", "b"]


def test_casts_are_removed_by_hash_alone(spark):
    rows = [
        {"Fid": 1, "MessageType": "CastAdd", "Hash": "a"},
        {"Fid": 2, "MessageType": "CastAdd", "Hash": "b"},
        {"Fid": 9, "MessageType": "CastRemove", "Hash": "r", "TargetHash": "a"},
        {"Fid": 9, "MessageType": "CastRemove", "Hash": "s", "TargetHash": ""},
    ]
    assert hashes(state.live_casts(flat(spark, "casts", rows))) == ["b"]


def test_profiles_by_highest_and_by_latest(spark):
    rows = [
        {"Fid": 1, "UserDataType": "Bio", "Value": "z", "Timestamp": 1, "Hash": "a"},
        {"Fid": 1, "UserDataType": "Bio", "Value": "b", "Timestamp": 2, "Hash": "a"},
        {"Fid": 1, "UserDataType": "Bio", "Value": "c", "Timestamp": 2, "Hash": "b"},
        {"Fid": 2, "UserDataType": "Url", "Value": "u", "Timestamp": 2, "Hash": "b"},
    ]
    log = flat(spark, "profiles", rows)
    highest = {r["Fid"]: r["Bio"] for r in state.wide_profiles(log).collect()}
    latest = {r["Fid"]: r["Bio"] for r in state.latest_profiles(log).collect()}
    assert highest == {1: "z", 2: None}
    assert latest == {1: "c", 2: None}


def test_first_pro_tier_decides(spark):
    schema = "fid bigint, tier_subscriptions array<struct<tier_type: string, expires_at: bigint>>"
    rows = [
        (1, [("Basic", 500), ("Pro", 50), ("Pro", 500)]),
        (2, [("Pro", 101)]),
        (3, [("Pro", 100)]),
        (4, []),
        (5, None),
    ]
    found = state.active_pro(spark.createDataFrame(rows, schema), 100).collect()
    assert [r["fid"] for r in found] == [2]


def test_first_listed_of_the_newest_addresses(spark):
    schema = "fid bigint, type string, timestamp bigint, address string, protocol string, seq bigint"
    add, other = "VerificationAddEthAddress", "VerificationRemove"
    rows = [
        (1, add, 5, "a", "Ethereum", 1),
        (1, add, 9, "b", "Ethereum", 2),
        (1, add, 9, "c", "Ethereum", 3),
        (1, add, 10, "d", "Solana", 4),
        (1, other, 11, "e", "Ethereum", 5),
        (2, add, 0, "f", "Ethereum", 1),
    ]
    found = state.latest_addresses(spark.createDataFrame(rows, schema)).collect()
    assert [tuple(r) for r in found] == [(1, "b")]


def test_compact_links_pieces_make_the_whole_list(spark):
    links = flat(spark, "links", [link(1, t, 1) for t in (7, 3, 3, 25, 12, 19)])
    pieces = state.compact_links(links, span=10).orderBy("Part").collect()
    assert [p["TargetFids"] for p in pieces] == [[3, 7], [12, 19], [25]]


def test_replies_join_one_parent_even_if_copied(spark):
    parent = {"Fid": 1, "MessageType": "CastAdd", "Hash": "0xaa", "Timestamp": 5}
    rows = [parent, parent] + [
        {"Fid": 2, "Hash": "0xbb", "Timestamp": 9, "ParentCastId": "1:0xaa"},
        {"Fid": 2, "Hash": "0xcc", "Timestamp": 9, "ParentCastId": "1:0xdd"},
    ]
    found = {r["Hash"]: r["DelaySeconds"] for r in graph.replies(flat(spark, "casts", rows)).collect()}
    assert found == {"0xbb": 4, "0xcc": None}
    assert graph.replies(flat(spark, "casts", rows)).count() == 2


def test_reconcile_counts_lost_extra_and_repeated(spark):
    source = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "id bigint")
    sink = spark.createDataFrame([(i,) for i in (1, 2, 2, 3, 9)], "id bigint")
    row = graph.reconcile(source, sink, ["id"]).first().asDict()
    assert row == {"source_ids": 4, "sink_ids": 4, "missing": 1, "unexpected": 1, "duplicated": 1}
