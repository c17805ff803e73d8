"""Every registered query, by name. All of them run over the whole landed tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyreel.config import standard_config
from tallyreel.functions import cleaning as C
from tallyreel.functions import timestamps as TS
from tallyreel.functions.numeric import round_half_away
from tallyreel.operators.classify import classify_threshold
from tallyreel.operators.collapse import collapse_agreeing
from tallyreel.operators.dedupe import dedupe_first
from tallyreel.operators.history import scd2_windows
from tallyreel.operators.intervals import merge_intervals
from tallyreel.operators.lookups import keep_known
from tallyreel.operators.rates import temporal_rate_join
from tallyreel.operators.sessions import sessionize
from tallyreel.operators.spine import spine_rollup
from tallyreel.plans import marts_product
from tallyreel.plans.build import Models, table_of
from tallyreel.plans.descriptions import COLUMNS, TABLES
from tallyreel.profiling import keys as K
from tallyreel.profiling import sequences as SEQ
from tallyreel.profiling import sessions as SES
from tallyreel.profiling import shapes as SH
from tallyreel.profiling import subscriptions as SUB
from tallyreel.quality import checks as Q
from tallyreel.quality import declared as D
from tallyreel.quality.suite import failing_count, run_declared
from tallyreel.profiling.shared import stacked
from tallyreel.sources import raw as R
from tallyreel.sources.sample_feed import landed_sample
from tallyreel.sources.sinks import DATA_NAMESPACE, documented_columns, persist_docs, staging_view, write_mart
from tallyreel.sources.workspace import shared_folder

# The sample feed takes its channels from a market segment column with its own five values.
SAMPLE_CHANNELS = ["automobile", "building", "furniture", "household", "machinery"]

Plan = Callable[[Models, str], DataFrame]
PLANS: dict[str, Plan] = {}


def plan(name: str) -> Callable[[Plan], Plan]:
    def register(function: Plan) -> Plan:
        PLANS[name] = function
        return function

    return register


def _spark(m: Models) -> SparkSession:
    return m.raw.rates.sparkSession


def _events(m: Models) -> DataFrame:
    return m.raw["playback_events"]


def _subs(m: Models) -> DataFrame:
    return m.raw["subscriptions"]


def _catalog(m: Models) -> DataFrame:
    return m.raw["asset_catalog"]


def _users(m: Models) -> DataFrame:
    return m.raw["users"]


def _hot_sessions(m: Models):
    return m.raw.hot("playback_events", "session_id")


def _hot_users(m: Models):
    return m.raw.hot("subscriptions", "user_id")


def _hot_user_ids(m: Models):
    return m.raw.hot("subscriptions", "user_id", "bigint")


# ------------------------------------------------------------------ sources and sinks


def _written_csv(m: Models, df: DataFrame, name: str) -> str:
    path = f"{shared_folder(_spark(m))}/extracts/{name}.csv"
    R.write_raw_csv(df, path)
    return path


@plan("read_raw_csv")
def _(m, sf_dir):
    """The catalog written as CSV and read back as text; titles hold quotes, commas, backslashes and, in part, line breaks."""
    broken = F.when(F.col("sport") == "FB", "\r\n").when(F.col("asset_type") == "LIVE", "\n").otherwise(" ")
    awkward = F.concat(F.lit('The "'), F.col("title"), F.lit('",'), broken, F.lit("part 1\\"))
    path = _written_csv(m, _catalog(m).withColumn("title", awkward), "asset_catalog_quoted")
    return R.read_raw_csv(_spark(m), path, R.RAW_COLUMNS["asset_catalog"])


@plan("land_raw")
def _(m, sf_dir):
    """All four extracts from CSV to catalog tables; a table that is no longer delivered goes."""
    spark = _spark(m)
    folder = f"{shared_folder(spark)}/extracts"
    for name in R.RAW_COLUMNS:
        _written_csv(m, m.raw[name], name)
    R.land_raw_tables({"retired": _users(m).limit(1)}, "raw_landed")
    R.land_raw_tables(R.read_extracts(spark, folder), "raw_landed")
    landed = [r["tableName"] for r in spark.sql("SHOW TABLES IN raw_landed").collect()]
    return R.landing_report({t: spark.table(f"raw_landed.{t}") for t in landed})


PLANS["landing_report"] = lambda m, _: R.landing_report(m.raw.tables)


@plan("load_seed")
def _(m, sf_dir):
    """The rate table written as CSV, loaded with its declared types, beside the rows that use it."""
    rates = R.load_seed(_spark(m), _written_csv(m, m.raw.rates, "fx_rates"))
    return SUB.rates_in_use(_subs(m), rates)


@plan("staging_view")
def _(m, sf_dir):
    view = staging_view(m.stg_users, "stg_users_view")
    return view.groupBy("home_state").agg(F.count(F.lit(1)).alias("users"))


def _written_assets(m: Models, table: str) -> DataFrame:
    return write_mart(m.dim_asset, DATA_NAMESPACE, table, f"{shared_folder(_spark(m))}/{DATA_NAMESPACE}")


PLANS["write_mart"] = lambda m, _: _written_assets(m, "dim_asset")


@plan("persist_docs")
def _(m, sf_dir):
    """Documented columns of a written table, each with its count of set values."""
    df = _written_assets(m, "dim_asset_documented")
    name = f"{DATA_NAMESPACE}.dim_asset_documented"
    persist_docs(df.sparkSession, name, TABLES["dim_asset"], COLUMNS["dim_asset"])
    documented = documented_columns(df.sparkSession, name).filter(F.col("comment").isNotNull())
    cells = [F.struct(F.lit(c).alias("col_name"), F.count(c).alias("filled")) for c in df.columns]
    filled = df.agg(F.array(*cells).alias("a")).select(F.explode("a").alias("c")).select("c.*")
    return documented.join(filled, "col_name")


@plan("project_vars")
def _(m, sf_dir):
    """The three declared values beside the rows each of them decides."""
    config = m.config
    completion = F.col("completion_pct")
    sentinel = F.to_timestamp_ntz(F.lit(config.open_window_sentinel))
    sessions = m.fct_session.agg(
        F.count_if(completion >= config.engaged_min_completion).alias("at_or_above_engaged"),
        F.count_if(completion >= config.sampled_min_completion).alias("at_or_above_sampled"),
    )
    return sessions.select(
        "*",
        m.dim_subscription_history.agg(F.count_if(F.col("valid_to") == sentinel)).scalar().alias("open_windows"),
    )


# ------------------------------------------------------------------ cleaning expressions

PLANS["normalize_timestamp"] = lambda m, _: _events(m).select(
    "event_id", TS.normalize_timestamp(F.col("event_ts")).alias("event_at_utc")
)
PLANS["timestamp_source_format"] = lambda m, _: _events(m).select(
    "event_id", TS.timestamp_source_format(F.col("event_ts")).alias("event_ts_source_format")
)
PLANS["surrogate_key"] = lambda m, _: _events(m).select(
    "event_id", C.surrogate_key([F.col("session_id"), F.col("user_id"), F.col("event_ts")]).alias("row_key")
)
PLANS["map_category_sport"] = lambda m, _: _catalog(m).select(
    "asset_id", C.map_category(F.col("sport"), C.SPORT_ALIASES).alias("sport")
)
PLANS["map_category_state"] = lambda m, _: _users(m).select(
    "user_id", C.map_category(F.col("home_state"), C.STATE_ALIASES).alias("home_state")
)
PLANS["null_out_invalid"] = lambda m, _: _catalog(m).select(
    "asset_id",
    C.null_out_below(C.number(F.col("duration_seconds")), 1.0).alias("duration_seconds"),
    C.number(F.col("duration_seconds")).alias("duration_seconds_raw"),
    C.is_below(C.number(F.col("duration_seconds")), 1.0).alias("has_invalid_duration"),
)
PLANS["replay_flag"] = lambda m, _: _catalog(m).select(
    "asset_id", "title", C.replay_flag(F.col("title")).alias("is_replay")
)
PLANS["keep_raw_copy"] = lambda m, _: m.stg_users.select("user_id", "home_state", "home_state_raw")
PLANS["typed_cast"] = lambda m, _: _events(m).select(
    C.whole_number(F.col("event_id")).alias("event_id"),
    C.number(F.col("position_seconds")).alias("position_seconds"),
    C.whole_number(F.col("bitrate_kbps"), "int").alias("bitrate_kbps"),
    F.col("session_id").try_cast("bigint").alias("session_number"),
)
PLANS["anonymous_flag"] = lambda m, _: _events(m).select(
    "event_id", F.col("user_id").isNull().alias("is_anonymous_view")
)

# ------------------------------------------------------------------ staging and marts


def _model(name: str) -> Plan:
    return lambda m, _: getattr(m, name)


for _name in (
    "stg_playback_events",
    "stg_asset_catalog",
    "stg_subscriptions",
    "stg_users",
    "dim_asset",
    "dim_subscription_history",
    "fct_user_paid_spells",
    "fct_session",
    "dim_user",
    "fct_session_engagement",
):
    PLANS[_name] = _model(_name)


def _stable_average(df: DataFrame) -> DataFrame:
    """An average of doubles depends on the order of addition in its last digits."""
    return df.withColumn("avg_completion_pct", round_half_away(F.col("avg_completion_pct"), 9))


PLANS["fct_user_engagement"] = lambda m, _: _stable_average(m.fct_user_engagement)
PLANS["classified_sessions"] = lambda m, _: marts_product.classified_sessions(
    m.fct_session, m.fct_session_engagement
).select("session_id", "user_id", "watch_minutes", "completion_pct", "is_engaged_view")
PLANS["user_measures"] = lambda m, _: _stable_average(
    marts_product.user_measures(
        m.fct_session.withColumn("is_engaged_view", marts_product.engaged_flag(m.config))
    )
)

# ------------------------------------------------------------------ operators on their own

PLANS["dedupe_first"] = lambda m, _: dedupe_first(
    _events(m), ["event_id"], ["session_id", "event_ts", "position_seconds"]
)
PLANS["collapse_agreeing"] = lambda m, _: collapse_agreeing(
    _catalog(m), "sport", ["home_school", "away_school", "scheduled_start_ts"]
)
PLANS["scd2_windows"] = lambda m, _: scd2_windows(
    m.stg_subscriptions.select("subscription_change_key", "subscription_id", "status", "effective_at_utc"),
    "subscription_id",
    "effective_at_utc",
    "subscription_change_key",
    m.config.open_window_sentinel,
    m.raw.hot("subscriptions", "subscription_id", "bigint"),
)


@plan("merge_intervals")
def _(m, sf_dir):
    """Continuous subscription of any kind per user: every window merges, trials included."""
    return merge_intervals(
        m.dim_subscription_history.filter(~F.col("status").isin("canceled", "expired")),
        "user_id",
        "valid_from",
        "valid_to",
        ["subscription_change_key"],
        "stretch",
        _hot_user_ids(m),
        windows=F.count(F.lit(1)),
    )


PLANS["sessionize"] = lambda m, _: sessionize(
    m.stg_playback_events,
    "session_id",
    "event_at_utc",
    "event_type",
    "position_seconds",
    "is_anonymous_view",
    ["user_id", "asset_id", "device_type", "app_version", "bitrate_kbps"],
)
PLANS["classify_threshold"] = lambda m, _: m.fct_session.select(
    "session_id",
    classify_threshold(
        F.col("buffers_per_10min"), [(0.5, "smooth"), (1.5, "uneven")], "rough"
    ).alias("playback_quality"),
)


@plan("spine_rollup")
def _(m, sf_dir):
    """Every account with its number of subscription changes."""
    changes = m.stg_subscriptions.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("changes"), F.max("effective_at_utc").alias("last_change_at")
    )
    return spine_rollup(m.stg_users.select("user_id"), changes, "user_id", {"changes": 0})


PLANS["temporal_rate_join"] = lambda m, _: temporal_rate_join(
    m.stg_subscriptions.select(
        "subscription_change_key", "currency", F.col("effective_at_utc").cast("date").alias("on_date")
    ),
    m.raw.rates,
    "currency",
    "on_date",
    ["rate_to_usd"],
)


@plan("temporal_rate_join_daily")
def _(m, sf_dir):
    """A rate for each day and one for each month that has changes: many periods a currency, two for each change."""
    dated = m.stg_subscriptions.select(
        "subscription_change_key", "currency", F.col("effective_at_utc").cast("date").alias("on_date")
    )
    days = dated.select("currency", "on_date").dropna().distinct()
    daily = days.select(
        "currency",
        (F.unix_date("on_date") % 100 + 1).cast("double").alias("rate_to_usd"),
        F.col("on_date").alias("valid_from"),
        F.col("on_date").alias("valid_to"),
    )
    first = F.trunc("on_date", "month")
    monthly = days.select(
        "currency", F.lit(0.5).alias("rate_to_usd"), first.alias("valid_from"), F.last_day("on_date").alias("valid_to")
    ).distinct()
    return temporal_rate_join(dated, daily.union(monthly), "currency", "on_date", ["rate_to_usd", "valid_to"], many_periods=True)


PLANS["orphan_filter_join"] = lambda m, _: keep_known(m.stg_subscriptions, m.stg_users, "user_id").select(
    "subscription_change_key", "user_id"
)

# ------------------------------------------------------------------ declared checks


PLANS["checks_source"] = lambda m, _: run_declared(table_of(m), D.source_checks(SAMPLE_CHANNELS))
PLANS["checks_staging"] = lambda m, _: run_declared(table_of(m), D.STAGING_CHECKS)
PLANS["checks_marts_data"] = lambda m, _: run_declared(table_of(m), D.DATA_CHECKS)
PLANS["checks_marts_product"] = lambda m, _: run_declared(table_of(m), D.PRODUCT_CHECKS)


@plan("checks_seed")
def _(m, sf_dir):
    """Seed checks, and changes whose currency and day no rate covers."""
    uncovered = m.stg_subscriptions.filter(F.col("usd_billing_period_amount").isNull())
    return stacked(
        [
            run_declared(table_of(m), D.SEED_CHECKS),
            failing_count("stg_subscriptions: no rate", uncovered),
        ]
    )


# Generic checks on raw data that does break them, so that each shows its failing rows.
PLANS["check_not_null"] = lambda m, _: Q.check_not_null(_events(m), "user_id").select("event_id", "session_id")
PLANS["check_unique"] = lambda m, _: Q.check_unique(_events(m), "event_id")
PLANS["check_accepted_values"] = lambda m, _: Q.check_accepted_values(
    _catalog(m), "sport", D.SPORT_NAMES
).select("asset_id", "title", "sport")
PLANS["check_relationships"] = lambda m, _: Q.check_relationships(
    _events(m), "asset_id", _catalog(m), "asset_id"
).select("event_id", "asset_id")
PLANS["check_unique_combination"] = lambda m, _: Q.check_unique_combination(
    _catalog(m), ["asset_id", "sport"]
)
PLANS["check_expression"] = lambda m, _: Q.check_expression(_users(m), D.STATE_SHAPE).select(
    "user_id", "home_state"
)


def _reported(name: str, failing: Callable[[Models], DataFrame]) -> None:
    PLANS[name] = lambda m, _: failing_count(name, failing(m))


_reported("assert_collapse_columns_agree", lambda m: Q.assert_collapse_columns_agree(m.stg_asset_catalog))
_reported("assert_duplicates_identical", lambda m: Q.assert_duplicates_identical(_events(m)))
_reported(
    "assert_row_reconciliation", lambda m: Q.assert_row_reconciliation(_events(m), m.stg_playback_events)
)
_reported(
    "assert_rowcount_equal",
    lambda m: Q.assert_rowcount_equal(
        {
            "stg_asset_catalog": (_catalog(m), m.stg_asset_catalog),
            "stg_users": (_users(m), m.stg_users),
            "stg_subscriptions": (_subs(m), m.stg_subscriptions),
        }
    ),
)
_reported(
    "assert_exclusions_reconcile",
    lambda m: Q.assert_exclusions_reconcile(m.stg_playback_events, m.dim_asset, m.fct_session),
)
_reported(
    "assert_windows_contiguous",
    lambda m: Q.assert_windows_contiguous(
        m.dim_subscription_history, m.raw.hot("subscriptions", "subscription_id", "bigint")
    ),
)
_reported(
    "assert_intervals_no_overlap",
    lambda m: Q.assert_intervals_no_overlap(
        m.fct_user_paid_spells, "user_id", "paid_from", "paid_to", "spell_number", _hot_user_ids(m)
    ),
)
_reported(
    "assert_spine_grain", lambda m: Q.assert_spine_grain(m.fct_user_engagement, m.stg_users, m.fct_session)
)


@plan("intervals_before_merge")
def _(m, sf_dir):
    """The no-overlap check on unmerged paid windows, where it has to fire."""
    paid = m.dim_subscription_history.filter(F.col("is_paid_plan") & F.col("is_active_state"))
    failing = Q.assert_intervals_no_overlap(
        paid, "user_id", "valid_from", "valid_to", "subscription_change_key", _hot_user_ids(m)
    )
    return failing.select("subscription_change_key", "user_id", "valid_from", "furthest_end")


# ------------------------------------------------------------------ profiles of raw text

_EVENT_KEYS = [c for c in R.RAW_COLUMNS["playback_events"] if c != "event_id"]

# The labels of keys and relations in these reports.
PLANS["profile_key_uniqueness"] = lambda m, _: K.key_uniqueness(
    [
        ("playback_events.event_id", _events(m), ["event_id"]),
        ("users.user_id", _users(m), ["user_id"]),
        ("asset_catalog.asset_id", _catalog(m), ["asset_id"]),
        ("subscriptions.subscription_id", _subs(m), ["subscription_id"]),
        ("subscriptions.(sub_id, eff_ts)", _subs(m), ["subscription_id", "event_effective_ts"]),
    ]
)
PLANS["profile_string_shapes"] = lambda m, _: SH.string_shapes(_events(m), "event_ts")
PLANS["profile_nulls_blanks"] = lambda m, _: SH.nulls_and_blanks(_events(m), _EVENT_KEYS)
PLANS["profile_categorical"] = lambda m, _: SH.categorical(
    [
        ("playback_events", _events(m), ["event_type", "device_type", "app_version"]),
        ("asset_catalog", _catalog(m), ["asset_type", "sport"]),
        ("subscriptions", _subs(m), ["status", "plan_type", "currency"]),
        ("users", _users(m), ["acquisition_channel"]),
    ]
)
PLANS["profile_code_oddities"] = lambda m, _: SH.code_oddities(_users(m), "home_state")


def _links(m: Models, labels: list[str]):
    named = _events(m).filter(F.col("user_id").isNotNull() & (F.col("user_id") != ""))
    return [
        (labels[0], _events(m), _catalog(m), "asset_id"),
        (labels[1], named, _users(m), "user_id"),
        (labels[2], _subs(m), _users(m), "user_id"),
    ]


PLANS["profile_fk_orphans_leftjoin"] = lambda m, _: K.fk_orphans_leftjoin(
    _links(
        m,
        [
            "playback_events.asset_id -> asset_catalog",
            "playback_events.user_id -> users (non-blank only)",
            "subscriptions.user_id -> users",
        ],
    )
)
PLANS["profile_fk_orphans_antijoin"] = lambda m, _: K.fk_orphans_antijoin(
    [
        ("events -> asset_catalog", _events(m), _catalog(m), "asset_id"),
        ("events -> users (non-null only)", _events(m), _users(m), "user_id"),
        ("subscriptions -> users", _subs(m), _users(m), "user_id"),
    ]
)
PLANS["profile_numeric_sanity"] = lambda m, _: K.numeric_sanity(
    [
        ("playback_events.position_seconds", _events(m), "position_seconds"),
        ("playback_events.bitrate_kbps", _events(m), "bitrate_kbps"),
        ("asset_catalog.duration_seconds", _catalog(m), "duration_seconds"),
        ("subscriptions.mrr_amount", _subs(m), "mrr_amount"),
    ]
)
PLANS["profile_session_volume"] = lambda m, _: SES.session_volume(_events(m))
PLANS["profile_session_invariants"] = lambda m, _: SES.session_invariants(_events(m))
PLANS["profile_session_composition"] = lambda m, _: SES.session_composition(_events(m))
PLANS["profile_rows_per_entity"] = lambda m, _: SUB.rows_per_entity(_subs(m))
PLANS["profile_status_plan_matrix"] = lambda m, _: SUB.amounts_by(
    _subs(m), "status", "plan_type", ("distinct_mrr", "min_mrr", "max_mrr")
)
PLANS["profile_coverage"] = lambda m, _: K.coverage(_users(m), _subs(m), _events(m))
PLANS["profile_fanout"] = lambda m, _: K.fanout(
    _events(m),
    _catalog(m),
    "asset_id",
    ["events_before", "events_after_inner_join", "events_after_left_join"],
)
PLANS["profile_duplicate_key_shape"] = lambda m, _: K.duplicate_key_shape(_catalog(m))
PLANS["profile_duplicate_identity"] = lambda m, _: K.duplicate_identity(_events(m))
PLANS["profile_encoding_by_app_version"] = lambda m, _: SH.encoding_by(_events(m), "app_version", "event_ts")
PLANS["profile_encoding_by_device_type"] = lambda m, _: SH.encoding_by(_events(m), "device_type", "event_ts")
PLANS["profile_encoding_period"] = lambda m, _: SH.encoding_period(_events(m), "event_ts")
PLANS["profile_null_pattern"] = lambda m, _: SES.null_pattern(_events(m))
PLANS["profile_bad_durations"] = lambda m, _: SH.bad_durations(
    _catalog(m), ["asset_id", "asset_type", "sport", "duration_seconds"], nulls_too=True
)
PLANS["profile_position_vs_duration"] = lambda m, _: SES.position_vs_duration(_events(m), _catalog(m))
PLANS["profile_currency"] = lambda m, _: SUB.amounts_by(
    _subs(m), "currency", "plan_type", ("distinct_amounts", "min_amt", "max_amt")
)
PLANS["profile_heartbeat_cadence"] = lambda m, _: SES.heartbeat_cadence(_events(m), _hot_sessions(m), 15)
PLANS["profile_session_quantiles"] = lambda m, _: SES.session_quantiles(_events(m))
PLANS["profile_completion_histogram"] = lambda m, _: SES.completion_histogram(
    _events(m), _catalog(m), clamp_first=False
)
PLANS["profile_ts_formats"] = lambda m, _: SH.ts_formats(
    [
        ("subscriptions.event_effective_ts", _subs(m), "event_effective_ts"),
        ("users.signup_ts", _users(m), "signup_ts"),
        ("asset_catalog.scheduled_start_ts", _catalog(m), "scheduled_start_ts"),
    ]
)
PLANS["profile_subs_per_user"] = lambda m, _: SUB.subs_per_user(_subs(m))
PLANS["profile_overlapping_subs"] = lambda m, _: SUB.overlapping_subs(_subs(m), _hot_users(m))
PLANS["sample_subscription"] = lambda m, _: SUB.sample_subscription(_subs(m))
PLANS["sample_multi_sub_user"] = lambda m, _: SUB.sample_multi_sub_user(_subs(m))
PLANS["profile_status_paths"] = lambda m, _: SUB.status_paths(_subs(m), m.raw.hot("subscriptions", "subscription_id"))
PLANS["profile_stops_per_session"] = lambda m, _: SES.events_per_session(_events(m), "stop", "n_stops")
PLANS["profile_stop_vs_duration"] = lambda m, _: SES.stop_vs_duration(_events(m), _catalog(m))
# Relation labels.
PLANS["profile_stop_vs_heartbeat"] = lambda m, _: SES.stop_vs_heartbeat(
    _events(m), ["identical", "stop is later", "stop is EARLIER", "null somewhere"]
)
PLANS["profile_stop_by_type"] = lambda m, _: SES.stop_by_type(_events(m), _catalog(m))
PLANS["profile_sessions_per_user_asset"] = lambda m, _: SES.sessions_per_user_asset(_events(m))
PLANS["profile_rewatchers"] = lambda m, _: SES.rewatchers(_events(m))
PLANS["profile_grain_comparison"] = lambda m, _: SES.grain_comparison(_events(m), _catalog(m))
PLANS["profile_resume_or_restart"] = lambda m, _: SES.resume_or_restart(_events(m))
PLANS["profile_position_jumps"] = lambda m, _: SES.position_jumps(_events(m), _hot_sessions(m))
PLANS["profile_pause"] = lambda m, _: SES.pause_behaviour(_events(m), _catalog(m))
PLANS["profile_user_quantiles"] = lambda m, _: SES.user_quantiles(_events(m))
PLANS["profile_whitespace"] = lambda m, _: SH.whitespace(
    {
        "asset_catalog": (_catalog(m), ["sport", "home_school", "title"]),
        "users": (_users(m), ["home_state", "acquisition_channel"]),
        "playback_events": (_events(m), ["device_type", "event_type"]),
        "subscriptions": (_subs(m), ["status"]),
    }
)
PLANS["profile_bad_codes"] = lambda m, _: SH.bad_codes(_users(m), "home_state", "users")
PLANS["profile_full_row_dupes"] = lambda m, _: K.full_row_dupes(
    {"users": _users(m), "subscriptions": _subs(m)}
)

# ------------------------------------------------------------------ profiles of cleaned events


def _ordered_profile(function: Callable) -> Plan:
    return lambda m, _: function(m.ordered_events, _hot_sessions(m))


PLANS["profile_sequence_sanity"] = _ordered_profile(SEQ.sequence_sanity)
PLANS["profile_pause_jump"] = _ordered_profile(SEQ.pause_jump)
PLANS["profile_event_after_pause"] = _ordered_profile(SEQ.event_after_pause)
PLANS["profile_plays_per_session"] = lambda m, _: SES.events_per_session(
    m.stg_playback_events, "play", "n_play"
)
PLANS["sample_paused_session"] = lambda m, _: SEQ.sample_paused_session(m.stg_playback_events)
PLANS["profile_overlap_kind"] = lambda m, _: SUB.overlap_kind(m.stg_subscriptions, _hot_user_ids(m))
PLANS["profile_concurrent_paid"] = lambda m, _: SUB.concurrent_paid(m.stg_subscriptions, _hot_user_ids(m))
PLANS["profile_clock_vs_playhead"] = _ordered_profile(SEQ.clock_vs_playhead)
PLANS["profile_divergence_summary"] = _ordered_profile(SEQ.divergence_summary)
PLANS["profile_after_buffer"] = _ordered_profile(SEQ.after_buffer)
PLANS["profile_stall_by_type"] = _ordered_profile(SEQ.stall_by_type)
PLANS["profile_cadence_regularity"] = _ordered_profile(SEQ.cadence_regularity)
PLANS["profile_zero_gap"] = _ordered_profile(SEQ.zero_gap)

# ------------------------------------------------------------------ ad-hoc questions

PLANS["duplicated_assets"] = lambda m, _: K.duplicated_assets(_catalog(m))
PLANS["ambiguous_playback"] = lambda m, _: K.ambiguous_playback(_events(m), _catalog(m))
PLANS["fanout_counts"] = lambda m, _: K.fanout(
    _events(m), _catalog(m), "asset_id", ["before_join", "after_inner", "after_left"]
)
PLANS["encoding_share"] = lambda m, _: SH.encoding_share(_events(m), "event_ts")
PLANS["sub_encoding_share"] = lambda m, _: SH.two_way_encoding(_subs(m), "event_effective_ts")
PLANS["sport_variants"] = lambda m, _: SH.spelling_variants(_catalog(m), "sport", "assets")
PLANS["broken_durations"] = lambda m, _: SH.bad_durations(
    _catalog(m), ["asset_id", "asset_type", "sport", "title", "duration_seconds"], nulls_too=False
)
PLANS["currency_by_plan"] = lambda m, _: SUB.smallest_amount(_subs(m))
PLANS["subscription_lifecycles"] = lambda m, _: SUB.status_paths(_subs(m), m.raw.hot("subscriptions", "subscription_id"))
PLANS["overlapping_pairs_list"] = lambda m, _: SUB.overlapping_pairs_list(_subs(m), _hot_users(m))
PLANS["heartbeat_gap_counts"] = lambda m, _: SES.heartbeat_cadence(_events(m), _hot_sessions(m), None)
PLANS["completion_deciles"] = lambda m, _: SES.completion_histogram(_events(m), _catalog(m), clamp_first=True)
# Relation labels.
PLANS["stop_vs_last_beat"] = lambda m, _: SES.stop_vs_heartbeat(
    _events(m), ["identical", "stop later", "stop earlier"]
)


_MODELS: dict[tuple[str, str], Models] = {}


def models(spark: SparkSession, sf_dir: str) -> Models:
    """The lazy tables of one folder, composed once per Spark application."""
    where = (spark.sparkContext.applicationId, sf_dir)
    if where not in _MODELS:
        _MODELS[where] = Models(landed_sample(spark, sf_dir), standard_config())
    return _MODELS[where]


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """One registered query over the tables of a folder."""
    return PLANS[name](models(spark, sf_dir), sf_dir)
