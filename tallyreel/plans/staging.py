"""Staging: one table per source. Types, encodings and spellings; orphans stay in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyreel.functions import cleaning as C
from tallyreel.functions.numeric import round_half_away
from tallyreel.functions.timestamps import normalize_timestamp, timestamp_source_format
from tallyreel.operators.dedupe import dedupe_first
from tallyreel.operators.rates import temporal_rate_join

SHORTEST_RUNTIME = 1.0  # Fixed value: seconds; anything below is a defect.


def _unique_events(raw: DataFrame) -> DataFrame:
    return dedupe_first(raw, ["event_id"], ["session_id", "event_ts", "position_seconds"])


def _in_session() -> dict[str, Column]:
    """Where an event stands in its session, and what it is."""
    return {
        "event_id": C.whole_number(F.col("event_id")),
        "session_id": F.col("session_id"),
        "event_type": F.col("event_type"),
        "event_at_utc": normalize_timestamp(F.col("event_ts")),
        "position_seconds": C.number(F.col("position_seconds")),
    }


def stg_playback_events(raw: DataFrame) -> DataFrame:
    """One row per event id."""
    c = {name: column.alias(name) for name, column in _in_session().items()}
    return _unique_events(raw).select(
        c["event_id"],
        c["session_id"],
        C.whole_number(F.col("user_id")).alias("user_id"),
        C.whole_number(F.col("asset_id")).alias("asset_id"),
        c["event_type"],
        c["event_at_utc"],
        timestamp_source_format(F.col("event_ts")).alias("event_ts_source_format"),
        c["position_seconds"],
        "device_type",
        "app_version",
        C.whole_number(F.col("bitrate_kbps"), "int").alias("bitrate_kbps"),
        F.col("user_id").isNull().alias("is_anonymous_view"),
    )


def ordered_events(raw: DataFrame) -> DataFrame:
    """The columns of ``stg_playback_events`` that the order of events in a session needs, with the same rows and values.

    Raw columns behind the event type only break ties between rows that are alike in everything before, so they are
    left out before copies are dropped instead of being sorted and moved.
    """
    kept = raw.columns[: raw.columns.index("event_type") + 1]
    placed = [c for c in ("event_ts", "position_seconds") if c not in kept]
    return _unique_events(raw.select(*kept, *placed)).select(*[c.alias(n) for n, c in _in_session().items()])


def stg_asset_catalog(raw: DataFrame) -> DataFrame:
    """One row per asset id, title and type; the id alone is not a key."""
    title, runtime = F.trim("title"), C.number(F.col("duration_seconds"))
    return raw.select(
        C.surrogate_key([F.col("asset_id"), title, F.col("asset_type")]).alias("asset_key"),
        C.whole_number(F.col("asset_id")).alias("asset_id"),
        title.alias("title"),
        "asset_type",
        C.replay_flag(F.col("title")).alias("is_replay"),
        C.map_category(F.col("sport"), C.SPORT_ALIASES).alias("sport"),
        F.col("sport").alias("sport_raw"),
        F.trim("home_school").alias("home_school"),
        F.trim("away_school").alias("away_school"),
        normalize_timestamp(F.col("scheduled_start_ts")).alias("scheduled_start_at_utc"),
        timestamp_source_format(F.col("scheduled_start_ts")).alias("scheduled_start_ts_source_format"),
        C.null_out_below(runtime, SHORTEST_RUNTIME).alias("duration_seconds"),
        runtime.alias("duration_seconds_raw"),
        C.is_below(runtime, SHORTEST_RUNTIME).alias("has_invalid_duration"),
    )


def stg_subscriptions(raw: DataFrame, rates: DataFrame, many_periods: bool | None = None) -> DataFrame:
    """One row per change, with the amount in USD at the rate of the change's day; see ``temporal_rate_join``."""
    typed = raw.select(
        C.surrogate_key([F.col("subscription_id"), F.col("event_effective_ts")])
        .alias("subscription_change_key"),
        C.whole_number(F.col("subscription_id")).alias("subscription_id"),
        C.whole_number(F.col("user_id")).alias("user_id"),
        "plan_type",
        "status",
        normalize_timestamp(F.col("event_effective_ts")).alias("effective_at_utc"),
        timestamp_source_format(F.col("event_effective_ts")).alias("effective_ts_source_format"),
        C.number(F.col("mrr_amount")).alias("billing_period_amount"),
        "currency",
    ).withColumn("effective_date", F.col("effective_at_utc").cast("date"))
    rated = temporal_rate_join(typed, rates, "currency", "effective_date", ["rate_to_usd"], many_periods=many_periods)
    return rated.withColumns(
        {
            "usd_billing_period_amount": round_half_away(
                F.col("billing_period_amount") * F.col("rate_to_usd"), 2
            ),
            "billing_period_months": C.billing_months(F.col("plan_type")),
        }
    ).drop("effective_date", "rate_to_usd")


def stg_users(raw: DataFrame) -> DataFrame:
    """One row per account."""
    return raw.select(
        C.whole_number(F.col("user_id")).alias("user_id"),
        normalize_timestamp(F.col("signup_ts")).alias("signup_at_utc"),
        timestamp_source_format(F.col("signup_ts")).alias("signup_ts_source_format"),
        C.map_category(F.col("home_state"), C.STATE_ALIASES).alias("home_state"),
        F.col("home_state").alias("home_state_raw"),
        "acquisition_channel",
    )
