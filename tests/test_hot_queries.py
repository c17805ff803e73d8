"""Registered queries with a row limit so small that many groups are cut: results must not move."""

import pytest
from parity import connect, differences

from tallyreel import catalog, standard_config
from tallyreel.oracle.statements import statements
from tallyreel.plans.build import Models
from tallyreel.sources.raw import RawTables
from tallyreel.sources.sample_feed import landed_sample

SF_DIR = "/root/testdata/sf0.001"
BY_SESSION = [
    "profile_heartbeat_cadence",
    "profile_position_jumps",
    "profile_sequence_sanity",
    "profile_pause_jump",
    "profile_after_buffer",
    "profile_clock_vs_playhead",
    "profile_cadence_regularity",
    "profile_zero_gap",
]
BY_USER = [
    "profile_overlapping_subs",
    "overlapping_pairs_list",
    "profile_overlap_kind",
    "profile_concurrent_paid",
    "merge_intervals",
    "fct_user_paid_spells",
    "intervals_before_merge",
]
BY_SUBSCRIPTION = [
    "scd2_windows",
    "dim_subscription_history",
    "assert_windows_contiguous",
    "profile_status_paths",
]


def _cut(spark, limit):
    raw = landed_sample(spark, SF_DIR)
    return Models(RawTables(raw.tables, raw.rates, limit), standard_config())


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def cut_models(spark):
    return {"session": _cut(spark, 38), "user": _cut(spark, 9), "subscription": _cut(spark, 2)}


def test_some_groups_are_hot_and_some_are_not(cut_models):
    for limit, table, key in (
        ("session", "playback_events", "session_id"),
        ("user", "subscriptions", "user_id"),
        ("subscription", "subscriptions", "subscription_id"),
    ):
        raw = cut_models[limit].raw
        hot, groups = raw.hot(table, key).keys.count(), raw[table].select(key).distinct().count()
        assert 0 < hot < groups


@pytest.mark.parametrize(
    ("limit", "name"),
    [("session", n) for n in BY_SESSION]
    + [("user", n) for n in BY_USER]
    + [("subscription", n) for n in BY_SUBSCRIPTION],
)
def test_cut_groups_give_the_same_result(cut_models, duck, limit, name):
    result = catalog.PLANS[name](cut_models[limit], SF_DIR)
    assert differences(result, duck, statements()[name]) == []
