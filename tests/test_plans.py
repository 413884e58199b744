"""What the physical plans of the main operators look like."""

import re

import pytest
from conftest import DATA

from socialog.operators import analytics, filters, lookup, normalize, ordering, state
from socialog.plans import fixtures as fx
from socialog.streaming import delivery


@pytest.fixture(autouse=True)
def large_plans(settings):
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1"})


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> list[str]:
    return re.findall(r"Exchange (\w+)", plan(df))


def pushed(df) -> list[str]:
    return re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan(df))


@pytest.mark.parametrize("how, scans", [(state.live, 2), (state.live_ranked, 1)])
def test_lookup_on_live_links_reaches_every_scan(spark, how, scans):
    links = state.live_links(fx.links(spark, DATA), how=how)
    found = pushed(lookup.links_by_fid(links, 3, "follow"))
    assert len(found) == scans
    assert all("EqualTo(Fid,3)" in f and "EqualTo(LinkType,follow)" in f for f in found)


def test_page_token_reaches_the_scan(spark):
    rows = lookup.by_fid(fx.reactions(spark, DATA), 3)
    (found,) = pushed(ordering.page_rows(rows, ["Timestamp", "Hash"], 20, (9, "0xaa")))
    assert "EqualTo(Fid,3)" in found and "GreaterThanOrEqual(Timestamp,9)" in found


def test_normalising_and_delivery_do_not_shuffle(spark):
    for kind in fx.FLAT:
        assert exchanges(normalize.flatten(fx.messages(spark, DATA, kind), kind)) == []
    rows = delivery.to_queue_rows(delivery.normalized(fx.events(spark, DATA), fids=[1, 2]))
    assert exchanges(rows) == []
    assert "EqualTo(type,MERGE_MESSAGE)" in pushed(rows)[0]


def test_delivery_reads_only_the_fields_it_needs(spark):
    counted = plan(delivery.counts_per_second(fx.events(spark, DATA)))
    assert "cast_add_body" not in counted and "hash:" not in counted
    rows = plan(delivery.to_queue_rows(delivery.normalized(fx.events(spark, DATA))))
    assert "reaction_body" not in rows and "signer" not in rows


def test_live_shuffles_narrow_keys_and_adds_once(spark):
    assert exchanges(state.live_links(fx.links(spark, DATA))) == ["hashpartitioning"] * 3
    assert exchanges(state.live_links(fx.links(spark, DATA), how=state.live_ranked)) == [
        "hashpartitioning"
    ]


def test_top_n_needs_no_global_sort(spark):
    found = plan(analytics.top_followed(fx.links(spark, DATA)))
    assert "TakeOrderedAndProject" in found and "rangepartitioning" not in found
    assert "partial_count" in found


def test_state_is_pruned_to_the_columns_asked_for(spark):
    found = plan(analytics.top_followed(state.live_links(fx.links(spark, DATA))))
    assert "Signature" not in found and "Hash#" not in found


def test_members_share_one_partitioning(spark):
    members = state.pro_members(fx.tiers(spark, DATA), fx.verifications(spark, DATA), fx.NOW)
    assert len(exchanges(members)) == 2


def test_short_allow_list_is_a_pushed_set(spark):
    (found,) = pushed(filters.of_fids(fx.reactions(spark, DATA), [1, 2, 3]))
    assert "In(Fid, [1,2,3])" in found
