"""Operators on hand-made inputs."""

import datetime as dt
import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyreel.config import EngineConfig, standard_config
from tallyreel.operators.collapse import collapse_agreeing
from tallyreel.operators.dedupe import dedupe_first
from tallyreel.operators.distinct import distinct_counts
from tallyreel.operators.lookups import flag_unknown, keep_known, orphans
from tallyreel.operators import paths
from tallyreel.operators.paths import counted_paths, ordered_paths
from tallyreel.operators.quantiles import exact_quantiles
from tallyreel.operators.rates import covering_periods, temporal_rate_join
from tallyreel.operators.split_window import find_hot_groups
from tallyreel.plans import marts_data as MD
from tallyreel.plans import marts_product as MP
from tallyreel.plans import staging as ST
from tallyreel.profiling import keys as K
from tallyreel.profiling import sequences as SEQ
from tallyreel.profiling import sessions as SES
from tallyreel.profiling import subscriptions as SUB
from tallyreel.sources.raw import RAW_COLUMNS, standard_rates, text_schema


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def raw(spark, table, records):
    return spark.createDataFrame(
        [tuple(r.get(c) for c in RAW_COLUMNS[table]) for r in records], text_schema(RAW_COLUMNS[table])
    )


# ------------------------------------------------------------------ distinct counts


def test_distinct_counts_of_groups_and_of_the_whole(spark):
    rng = random.Random(3)
    data = [(rng.choice([None, "a", "b"]), rng.choice([None, *range(9)]), rng.choice([None, "x", "y"]), rng.randrange(4)) for _ in range(500)]
    data += [("hot", 1, "x", 0)] * 1000 + [("none", None, None, 1)]
    df = spark.createDataFrame(data, "g string, n int, s string, k int")
    counted, conditions = {"numbers": "n", "texts": "s"}, {"rows": F.lit(True), "zeros": F.col("k") == 0}
    direct = [F.count_distinct("n"), F.count_distinct("s"), F.count(F.lit(1)), F.count_if(F.col("k") == 0)]
    assert rows(distinct_counts(df, ["g"], counted, conditions)) == rows(df.groupBy("g").agg(*direct))
    assert rows(distinct_counts(df, [], counted, conditions)) == rows(df.agg(*direct))
    assert rows(distinct_counts(df.limit(0), [], counted, conditions)) == [(0, 0, 0, 0)]
    assert rows(distinct_counts(df, ["g"], {"groups": "g"}, {})) == rows(df.groupBy("g").agg(F.count_distinct("g")))


def test_only_distinct_tuples_are_multiplied(spark):
    copies = spark.range(0, 20_000, 1, 4).selectExpr("id % 10 s", "id % 10 u", "id % 5 a")
    out = distinct_counts(copies, [], {"s": "s", "u": "u", "a": "a"}, {"rows": F.lit(True)})
    assert rows(out) == [(10, 10, 5, 20_000)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    expand = plan[plan.index("Expand") :]
    assert expand.index("HashAggregate") < expand.index("Range")


# ------------------------------------------------------------------ dedupe, collapse, lookups


def test_dedupe_keeps_one_and_is_stable(spark):
    data = [(1, "a", "x"), (1, "a", "x"), (2, "b", "z"), (2, "b", "y"), (2, None, "q"), (3, None, None)]
    df = spark.createDataFrame(data, "id int, s string, w string")
    expected = [(1, "a", "x"), (2, "b", "y"), (3, None, None)]
    for parts in (1, 5):
        assert rows(dedupe_first(df.repartition(parts), ["id"], ["s"])) == expected


def test_dedupe_limits_copies_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "a", "x")], "id int, s string, w string")
    plan = dedupe_first(df, ["id"], ["s"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_collapse(spark):
    data = [(1, "A", 600.0, False), (1, "A", None, True), (2, "B", 50.0, False)]
    df = spark.createDataFrame(data, "id int, sport string, dur double, bad boolean")
    assert rows(collapse_agreeing(df, "id", ["sport", "dur"], ["bad"])) == [
        (1, "A", 600.0, True, 2, True),
        (2, "B", 50.0, False, 1, False),
    ]


def test_lookups(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (None, "d")], "u long, s string")
    known = spark.createDataFrame([(1,), (3,)], "u long")
    assert rows(keep_known(df, known, "u")) == [(1, "a")]
    assert rows(orphans(df, known, "u")) == [(2, "b")]
    with_null = known.unionByName(spark.createDataFrame([(None,)], "u long"))
    assert rows(orphans(df, with_null, "u")) == [(2, "b")]
    flagged = flag_unknown(df, known, "u", "s", "unknown").select("s", "unknown")
    assert rows(flagged) == [("a", False), ("b", True), ("c", False), ("d", False)]


# ------------------------------------------------------------------ rates


def test_temporal_rate_join(spark):
    day = dt.date
    rates = spark.createDataFrame(
        [("USD", 1.0, day(2020, 1, 1), day(2025, 1, 31)), ("USD", 2.0, day(2025, 2, 1), day(2999, 12, 31))],
        "currency string, rate double, valid_from date, valid_to date",
    )
    df = spark.createDataFrame(
        [(1, "USD", day(2025, 1, 31)), (2, "USD", day(2025, 2, 1)), (3, "USD", day(2019, 1, 1)), (4, "CHF", day(2025, 1, 1))],
        "id int, currency string, d date",
    )
    got = {r["id"]: r["rate"] for r in temporal_rate_join(df, rates, "currency", "d", ["rate"]).collect()}
    assert got == {1: 1.0, 2: 2.0, 3: None, 4: None}


def test_rate_join_survives_without_broadcast(spark):
    """Above the planner's size limit the same join sort-merges on the currency."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    subs = raw(
        spark,
        "subscriptions",
        [
            {
                "subscription_id": str(i),
                "user_id": "1",
                "plan_type": "annual",
                "status": "active",
                "event_effective_ts": "2025-03-01T10:00:00Z",
                "mrr_amount": "79.99",
                "currency": c,
            }
            for i, c in enumerate(["USD", "GBP", "EUR", "CHF"])
        ],
    )
    results = []
    try:
        for size in (limit, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
            staged = ST.stg_subscriptions(subs, standard_rates(spark))
            plan = staged._jdf.queryExecution().executedPlan().toString()
            assert ("SortMergeJoin" in plan) == (size == "-1")
            assert "NestedLoop" not in plan
            results.append(rows(staged.select("subscription_id", "usd_billing_period_amount")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert results[0] == results[1] == [(0, 79.99), (1, 101.59), (2, 87.19), (3, None)]


def test_many_rate_periods(spark):
    """10,000 daily periods of one currency beside overlapping and empty ones: same rows, few candidates."""
    base, draw = dt.date(1995, 1, 1), random.Random(4)
    day = lambda n: base + dt.timedelta(days=n)
    periods = [("USD", float(i), day(i), day(i)) for i in range(10_000)]
    periods += [("EUR", float(i), day(lo := draw.randrange(-900, 900)), day(lo + draw.randrange(-2, 400))) for i in range(60)]
    periods += [("GBP", 1.5, dt.date(1900, 1, 1), dt.date(2999, 12, 31)), ("GBP", 2.5, None, day(5)), (None, 1.0, day(0), day(9))]
    rows = [(i, draw.choice(["USD", "EUR", "GBP", "CHF", None]), draw.choice([None, day(draw.randrange(-1000, 10_100))])) for i in range(900)]
    rates = spark.createDataFrame(periods, "currency string, rate double, valid_from date, valid_to date")
    df = spark.createDataFrame(rows, "id int, currency string, d date")
    got = [tuple(r) for r in temporal_rate_join(df, rates, "currency", "d", ["rate"]).collect()]
    want = []
    for i, currency, d in rows:
        hits = [r for c, r, lo, hi in periods if c is not None and c == currency and d and lo and hi and lo <= d <= hi]
        want += [(i, currency, d, r) for r in hits or [None]]
    order = lambda row: (row[0], row[3] or 0)
    assert sorted(got, key=order) == sorted(want, key=order)
    # Without the residual condition the index offers at most twice as many candidates as there are days.
    days = spark.createDataFrame([("USD", n) for n in range(9000, 18_000)], "_rate_key string, _day int")
    bounds = rates.filter("currency = 'USD'").selectExpr("currency _rate_key", "unix_date(valid_from) _from", "unix_date(valid_to) _to", "rate")
    found = covering_periods(days, bounds, ["rate"])
    assert found.count() == len([n for n in range(9000, 18_000) if 0 <= n - (base - dt.date(1970, 1, 1)).days < 10_000])
    assert "BroadcastNestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("length", [1, 2, 3, 7, 30, 365, 1000])
def test_candidates_of_the_period_index(spark, length):
    """Adjoining periods of one length: a day meets two of them at most on average."""
    rows = [("k", i * length, (i + 1) * length - 1, float(i)) for i in range(200)]
    periods = spark.createDataFrame(rows, "_rate_key string, _from int, _to int, rate double")
    days = spark.range(200 * length).select(F.lit("k").alias("_rate_key"), F.col("id").cast("int").alias("_day"))
    assert covering_periods(days, periods, ["rate"]).count() == 200 * length
    width = max(1, 2 ** (length.bit_length() - 2))
    met = sum(sum(1 for i in range(b * width // length, min(199, (b * width + width - 1) // length) + 1)) for b in (d // width for d in range(200 * length)))
    assert met <= 2 * 200 * length


# ------------------------------------------------------------------ quantiles


@pytest.mark.parametrize("few", [False, True])
def test_quantiles_count_values_once(spark, tmp_path, few):
    spark.range(2000).selectExpr("'g' || id % 3 g", "id * 7919 % 311 v").write.parquet(str(tmp_path / "t"))
    result = exact_quantiles(spark.read.parquet(str(tmp_path / "t")), "g", "v", [0.1, 0.5, 0.9], few)
    assert result.count() == 9 and len(result.collect()) == 9
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan[: plan.index("Initial Plan")].count("FileScan") == 1


@pytest.mark.parametrize("n", [1, 2, 5, 997])
def test_exact_quantiles(spark, n):
    values = [float((i * 7919) % 311) / 7 for i in range(n)]
    df = spark.createDataFrame([("g", v) for v in values] + [("h", 1.0), ("h", None)], "g string, v double")
    got = {(r["g"], r["quantile"]): r["value"] for r in exact_quantiles(df, "g", "v", [0, 0.25, 0.5, 1]).collect()}
    few = exact_quantiles(df, "g", "v", [0, 0.25, 0.5, 1], few_groups=True)
    assert {(r["g"], r["quantile"]): r["value"] for r in few.collect()} == got
    assert "SortMergeJoin" not in few._jdf.queryExecution().executedPlan().toString()
    ordered = sorted(values)
    assert got[("g", 0.0)] == ordered[0] and got[("g", 1.0)] == ordered[-1]
    assert got[("g", 0.5)] == pytest.approx(statistics.median(values))
    position = (n - 1) * 0.25
    low = ordered[int(position)]
    high = ordered[min(int(position) + 1, n - 1)]
    assert got[("g", 0.25)] == pytest.approx(low + (high - low) * (position - int(position)))
    assert got[("h", 0.5)] == 1.0


# ------------------------------------------------------------------ sessions


def _event(i, kind, pos, **over):
    base = {
        "event_id": str(i),
        "session_id": "s1",
        "user_id": "1",
        "asset_id": "10",
        "event_type": kind,
        "event_ts": str(1756684800 + int(pos)),
        "position_seconds": str(pos),
        "device_type": "ios",
        "app_version": "5.0",
        "bitrate_kbps": "800",
    }
    return base | over


def _asset(asset_id, duration, title="Game", sport="VB"):
    return {
        "asset_id": asset_id,
        "title": title,
        "asset_type": "LIVE",
        "sport": sport,
        "home_school": "H",
        "away_school": "A",
        "scheduled_start_ts": "2025-09-01T19:00:00Z",
        "duration_seconds": duration,
    }


@pytest.fixture(scope="module")
def sessions(spark):
    events = [
        _event(1, "play", 0),
        _event(2, "heartbeat", 60),
        _event(3, "heartbeat", 60),
        _event(4, "heartbeat", 120),
        _event(5, "stop", 357),
        _event(5, "stop", 357),
        _event(11, "play", 0, session_id="s2", user_id=None),
        _event(12, "buffer", 10, session_id="s2", user_id=None),
        _event(21, "play", 0, session_id="s3", asset_id="11"),
        _event(31, "play", 0, session_id="s4", asset_id="99"),
        _event(41, "heartbeat", 60, session_id="s5", user_id="77"),
    ]
    users = raw(
        spark,
        "users",
        [{"user_id": u, "signup_ts": "2025-01-01T00:00:00Z", "home_state": "FL"} for u in ("1", "2")],
    )
    assets = raw(spark, "asset_catalog", [_asset("10", "600"), _asset("11", "-1")])
    staged = ST.stg_playback_events(raw(spark, "playback_events", events))
    dim = MD.dim_asset(ST.stg_asset_catalog(assets))
    return MD.fct_session(staged, dim, ST.stg_users(users)).cache()


def test_sessionize(sessions):
    got = {r["session_id"]: r for r in sessions.collect()}
    assert set(got) == {"s1", "s2", "s5"}  # invalid runtime and unknown asset are out
    s1 = got["s1"]
    assert (s1["watch_minutes"], s1["max_heartbeat_position_seconds"], s1["completion_pct"]) == (2, 120.0, 0.2)
    assert (s1["event_count"], s1["buffers_per_10min"], s1["has_unknown_user"]) == (5, 0.0, False)
    s2 = got["s2"]
    assert (s2["watch_minutes"], s2["completion_pct"], s2["buffers_per_10min"]) == (0, None, None)
    assert (s2["is_anonymous_session"], s2["has_unknown_user"]) == (True, False)
    assert got["s5"]["has_unknown_user"] is True


def test_engagement_of_null_completion(sessions):
    config = standard_config()
    got = {r["session_id"]: r for r in MP.fct_session_engagement(sessions, config).collect()}
    assert got["s1"]["engagement_tier"] == "sampled" and got["s1"]["is_engaged_view"] is False
    assert got["s2"]["engagement_tier"] == "engaged" and got["s2"]["is_engaged_view"] is None


def test_threshold_has_no_default():
    with pytest.raises(TypeError):
        EngineConfig()


# ------------------------------------------------------------------ users


def _change(sub, user, plan, status, at, amount="9.99"):
    return {
        "subscription_id": sub,
        "user_id": user,
        "plan_type": plan,
        "status": status,
        "event_effective_ts": at,
        "mrr_amount": amount,
        "currency": "USD",
    }


@pytest.fixture(scope="module")
def account_tables(spark):
    config = standard_config()
    changes = [
        _change("1", "1", "monthly", "active", "2025-01-01T00:00:00Z"),
        _change("1", "1", "monthly", "canceled", "2025-01-09T00:00:00Z"),
        _change("2", "1", "annual", "active", "2025-01-05T00:00:00Z", "79.99"),
        _change("3", "2", "free_trial", "trialing", "2025-01-01T00:00:00Z", "0.00"),
        _change("3", "2", "free_trial", "expired", "2025-01-15T00:00:00Z", "0.00"),
        _change("4", "3", "monthly", "active", "2025-01-10T00:00:00Z"),
        _change("5", "999", "monthly", "active", "2025-02-10T00:00:00Z"),
        _change("6", "2", "free_trial", "trialing", "2025-01-20 00:00:00", "0.00"),
    ]
    users = ST.stg_users(
        raw(
            spark,
            "users",
            [{"user_id": u, "signup_ts": "2025-01-01T00:00:00Z", "home_state": "FL"} for u in "1234"],
        )
    )
    staged = ST.stg_subscriptions(raw(spark, "subscriptions", changes), standard_rates(spark))
    history = MD.dim_subscription_history(staged, users, config)
    spells = MD.fct_user_paid_spells(history, config)
    return users, history, spells, MD.dim_user(users, history, spells)


def test_history(account_tables):
    _, history, _, _ = account_tables
    got = {(r["subscription_id"], r["valid_from"].day): r for r in history.collect()}
    assert 5 not in {s for s, _ in got}  # the orphan user's rows are absent
    assert got[(1, 1)]["valid_to"] == dt.datetime(2025, 1, 9) and not got[(1, 1)]["is_current_state"]
    assert got[(2, 5)]["monthly_amount"] == 6.67 and got[(1, 1)]["monthly_amount"] == 9.99
    assert got[(3, 1)]["monthly_amount"] == 0.0


def test_dim_user(account_tables):
    got = {r["user_id"]: r for r in account_tables[3].collect()}
    one = got[1]
    # The newest current state is the cancellation, while another subscription is still active.
    assert (one["latest_change_status"], one["is_currently_subscribed"]) == ("canceled", True)
    assert (one["has_ever_churned"], one["current_usd_mrr"], one["paid_spell_count"]) == (True, 6.67, 1)
    trial = got[2]
    assert (trial["has_ever_paid"], trial["has_ever_churned"], trial["subscription_count"]) == (False, False, 2)
    # The open spell counts up to the newest change of any known user, 20 January.
    assert got[3]["total_paid_days"] == 10
    nobody = got[4]
    assert (nobody["has_subscription"], nobody["subscription_count"], nobody["current_usd_mrr"]) == (False, 0, 0.0)
    assert nobody["latest_change_status"] is None and nobody["total_paid_days"] == 0


def test_user_engagement_spine(sessions, account_tables):
    fact = MP.fct_user_engagement(account_tables[3], sessions, standard_config())
    got = {r["user_id"]: r for r in fact.collect()}
    assert set(got) == {1, 2, 3, 4}
    idle = got[4]
    assert (idle["session_count"], idle["best_completion_pct"], idle["avg_completion_pct"]) == (0, None, None)
    assert idle["engagement_tier"] == "never_watched" and got[1]["engagement_tier"] == "sampled"
    joined = MP.fct_user_engagement(
        account_tables[3], sessions, standard_config(), MP.fct_session_engagement(sessions, standard_config())
    )
    assert rows(joined) == rows(fact)


# ------------------------------------------------------------------ profiles


def test_tuple_distinct_counts_null_members(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 2)], "a int, b int")
    assert rows(K.key_uniqueness([("k", df, ["a", "b"])])) == [("k", 3, 2, 1)]
    assert rows(K.full_row_dupes({"t": df})) == [("t", 1)]


def test_interpretation_tests_equality_first(spark):
    data = [(60, 60.0), (120, 120.0), (60, 0.0), (60, 300.0), (60, 30.0), (0, 0.0)]
    df = spark.createDataFrame(data, "time_delta long, pos_delta double").coalesce(1)
    assert [r[0] for r in df.select(SEQ.interpretation()).collect()] == [
        "normal playback",
        "dropped heartbeat(s), playhead kept pace",
        "STALLED (buffer or true pause)",
        "SEEK FORWARD",
        "playhead fell behind clock",
        "dropped heartbeat(s), playhead kept pace",
    ]


def test_fanout_counts_nulls_and_repeats(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,), (1,), (None,)], "k int")
    assert rows(K.fanout(child, parent, "k", ["b", "i", "l"])) == [(4, 6, 8)]
    assert rows(K.fk_orphans_leftjoin([("x", child, parent, "k")])) == [("x", 8, 2)]
    assert rows(K.fk_orphans_antijoin([("x", child, parent, "k")])) == [("x", 1, 1)]


@pytest.mark.parametrize("limit", [100, 4])
def test_ordered_paths(spark, limit):
    data = [(1, f"v{i % 3}" if i % 5 else None, i) for i in range(30)] + [(2, "a", 2), (2, "b", 1), (3, None, 1)]
    df = spark.createDataFrame(data, "k int, v string, t int").repartition(5)
    expected = {
        1: ">".join(v for k, v, _ in data if k == 1 and v is not None),
        2: "b>a",
        3: None,
    }
    hot = find_hot_groups(df, ["k"], limit)
    assert (hot is None) == (limit == 100)
    assert dict(rows(ordered_paths(df, "k", "v", ["t", "v"], ">", "path", hot))) == expected


def test_concurrent_paid_with_reversed_spans(spark):
    """An ending before the first activation: the pair formula still applies, by brute force."""
    data, spans = [], {}
    for i in range(60):
        user, start, end = i % 4, (i * 37) % 50, (i * 53) % 50
        spans[i] = (user, start, end)
        data += [(i, user, "monthly", "active", start), (i, user, "monthly", "canceled", end)]
    df = spark.createDataFrame(
        data, "subscription_id long, user_id long, plan_type string, status string, d int"
    ).withColumn(
        "effective_at_utc", F.timestamp_add("DAY", F.col("d"), F.to_timestamp_ntz(F.lit("2025-01-01 00:00:00")))
    )
    pairs, users = 0, set()
    for a, (ua, fa, ta) in spans.items():
        for b, (ub, fb, tb) in spans.items():
            if a < b and ua == ub and fa < tb and fb < ta:
                pairs += 1
                users.add(ua)
    assert any(f > t for _, f, t in spans.values())
    assert rows(SUB.concurrent_paid(df, None)) == [(pairs, len(users))]


def test_resume_or_restart_ties_and_nulls(spark):
    events = [
        _event(1, "play", 0, session_id="a"),
        _event(2, "play", 0, session_id="b"),
        _event(3, "play", 500, session_id="c"),
        _event(4, "play", 0, session_id="d", position_seconds="x"),
        _event(5, "play", 500, session_id="e", asset_id="12"),
        _event(6, "play", 700, session_id="f", asset_id="12"),
        _event(7, "play", 0, session_id="g", asset_id="13"),
    ]
    got = dict(rows(SES.resume_or_restart(raw(spark, "playback_events", events))))
    assert got == {
        "restarts near 0 (min_pos <= 60s)": 1,
        "starts later in the asset (resume-like)": 3,
    }


@pytest.mark.parametrize("limit", [3, 1000])
def test_counted_paths(spark, limit):
    """By fingerprints or by texts, the same paths have the same counts."""
    draw = random.Random(3)
    data = [(f"s{i % 40}" if i % 41 else None, draw.randrange(6), draw.choice(["a", "b", None])) for i in range(400)]
    data += [(f"short{i}", t, v) for i in range(30) for t, v in enumerate("ab" if i % 2 else "ba")]
    data += [(f"empty{i}", 1, None) for i in range(3)]
    df = spark.createDataFrame(data, "k string, t int, v string")
    hot = find_hot_groups(df, ["k"], limit)
    assert (hot is not None) == (limit == 3)
    want = Counter()
    for k in {r[0] for r in data}:
        values = [v for _, v in sorted((t, v) for j, t, v in data if j == k and v is not None)]
        want[">".join(values) if values else None] += 1
    got = counted_paths(df, "k", "v", ["t", "v"], ">", "path", "n", hot)
    assert {r["path"]: r["n"] for r in got.collect()} == want
    if hot:
        short = counted_paths(df, "k", "v", ["t", "v"], ">", "path", "n", hot, spell_bytes=3)
        shown = {r["path"]: r["n"] for r in short.collect()}
        assert shown["a>b"] == 15 and shown[None] == 3 and sum(shown.values()) == sum(want.values())
        assert len(shown) == len(want) and all(p is None or len(p) <= 3 or "values, fingerprint" in p for p in shown)


def test_colliding_fingerprints_are_found(spark, monkeypatch):
    df = spark.createDataFrame([(k, t, v) for k, p in (("x", "ab"), ("y", "ba")) for t, v in enumerate(p)], "k string, t int, v string")
    hot = find_hot_groups(df, ["k"], 1)
    monkeypatch.setattr(paths.F, "xxhash64", lambda *_: F.lit(5).cast("bigint"))
    with pytest.raises(paths.PathCollision):
        counted_paths(df, "k", "v", ["t", "v"], ">", "path", "n", hot)
