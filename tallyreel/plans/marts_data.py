"""Marts that state facts: assets, subscription history, paid spells, sessions, users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyreel.config import EngineConfig
from tallyreel.functions.cleaning import surrogate_key
from tallyreel.functions.numeric import round_half_away
from tallyreel.functions.timestamps import days_between
from tallyreel.operators.collapse import collapse_agreeing
from tallyreel.operators.history import scd2_windows
from tallyreel.operators.intervals import merge_intervals
from tallyreel.operators.lookups import flag_unknown, keep_known
from tallyreel.operators.sessions import sessionize
from tallyreel.operators.spine import spine_rollup
from tallyreel.operators.split_window import HotGroups

# Plans that cost money, states that count as paying, states that end a plan.
PAID_PLANS = ["monthly", "annual"]
ACTIVE_STATES = ["active"]
ENDED_STATES = ["canceled", "expired"]

ASSET_AGREE = ["sport", "home_school", "away_school", "scheduled_start_at_utc", "duration_seconds"]


def dim_asset(catalog: DataFrame) -> DataFrame:
    """One row per asset id, safe to join facts to."""
    return collapse_agreeing(catalog, "asset_id", ASSET_AGREE, ["has_invalid_duration"])


def _monthly(amount: str) -> Column:
    months = F.col("billing_period_months")
    return F.when(months == 0, F.lit(0.0)).otherwise(round_half_away(F.col(amount) / months, 2))


def dim_subscription_history(
    changes: DataFrame, users: DataFrame, config: EngineConfig, hot: HotGroups | None = None
) -> DataFrame:
    """One row per subscription state and the period it held, for known users."""
    known = keep_known(changes, users, "user_id")
    windows = scd2_windows(
        known,
        "subscription_id",
        "effective_at_utc",
        "subscription_change_key",
        config.open_window_sentinel,
        hot,
    )
    return windows.select(
        "subscription_change_key",
        "subscription_id",
        "user_id",
        "plan_type",
        "status",
        "currency",
        "valid_from",
        "valid_to",
        "is_current_state",
        _monthly("billing_period_amount").alias("monthly_amount"),
        _monthly("usd_billing_period_amount").alias("usd_monthly_amount"),
        "billing_period_months",
        F.col("plan_type").isin(PAID_PLANS).alias("is_paid_plan"),
        F.col("status").isin(ACTIVE_STATES).alias("is_active_state"),
    )


def fct_user_paid_spells(
    history: DataFrame, config: EngineConfig, hot: HotGroups | None = None
) -> DataFrame:
    """One row per continuous period in which a user paid."""
    paid = history.filter(F.col("is_paid_plan") & F.col("is_active_state")).select(
        "user_id", "subscription_id", "valid_from", "valid_to", "subscription_change_key"
    )
    spells = merge_intervals(
        paid,
        "user_id",
        "valid_from",
        "valid_to",
        ["subscription_change_key"],
        "spell_number",
        hot,
        subscriptions_in_spell=F.count(F.lit(1)),
        distinct_subscriptions=F.count_distinct("subscription_id"),
    ).withColumnsRenamed({"valid_from": "paid_from", "valid_to": "paid_to"})
    sentinel = F.to_timestamp_ntz(F.lit(config.open_window_sentinel))
    return spells.select(
        surrogate_key([F.col("user_id"), F.col("spell_number")]).alias("paid_spell_key"),
        *spells.columns,
        (F.col("paid_to") == sentinel).alias("is_open_ended"),
    )


def fct_session(events: DataFrame, assets: DataFrame, users: DataFrame) -> DataFrame:
    """One row per session on a known asset with a valid runtime."""
    rolled = sessionize(
        events,
        "session_id",
        "event_at_utc",
        "event_type",
        "position_seconds",
        "is_anonymous_view",
        ["user_id", "asset_id", "device_type", "app_version", "bitrate_kbps"],
    )
    playable = assets.filter(F.col("duration_seconds").isNotNull()).select(
        "asset_id",
        "sport",
        F.col("duration_seconds").alias("asset_duration_seconds"),
        F.col("has_ambiguous_identity").alias("asset_identity_ambiguous"),
    )
    on_asset = rolled.join(playable, "asset_id", "inner")
    flagged = flag_unknown(on_asset, users, "user_id", "session_id", "has_unknown_user")
    minutes = F.nullif(F.col("watch_minutes"), F.lit(0))
    return flagged.select(
        "session_id",
        "user_id",
        "asset_id",
        "is_anonymous_session",
        "session_start_at_utc",
        "session_end_at_utc",
        "event_count",
        "watch_minutes",
        "buffer_events",
        "max_heartbeat_position_seconds",
        "device_type",
        "app_version",
        "bitrate_kbps",
        "sport",
        "asset_duration_seconds",
        "asset_identity_ambiguous",
        "has_unknown_user",
        F.col("session_start_at_utc").cast("date").alias("session_date"),
        (F.col("max_heartbeat_position_seconds") / F.col("asset_duration_seconds")).alias("completion_pct"),
        round_half_away(F.col("buffer_events") * F.lit(10.0) / minutes, 3).alias("buffers_per_10min"),
    )


def subscription_state(history: DataFrame) -> DataFrame:
    """Per user: what they hold, held and pay. The latest change skips NULLs and has a tie-break."""
    active_now = F.col("is_current_state") & (F.col("status") == "active")
    # Amounts are whole cents, so a decimal sum is exact in whatever order rows arrive.
    paying = F.when(active_now, F.col("usd_monthly_amount")).otherwise(0.0).cast("decimal(28,2)")

    def latest(column: str) -> Column:
        return F.expr(
            f"max_by({column}, struct(valid_from, subscription_change_key)) FILTER "
            f"(WHERE is_current_state AND {column} IS NOT NULL AND valid_from IS NOT NULL)"
        ).alias(f"latest_change_{column}")

    return history.groupBy("user_id").agg(
        F.count_distinct("subscription_id").alias("subscription_count"),
        F.min("valid_from").alias("first_subscription_at"),
        latest("plan_type"),
        latest("status"),
        F.bool_or("is_paid_plan").alias("has_ever_paid"),
        F.bool_or(F.col("is_paid_plan") & F.col("status").isin(ENDED_STATES)).alias("has_ever_churned"),
        F.bool_or(active_now).alias("is_currently_subscribed"),
        F.sum(paying).cast("double").alias("current_usd_mrr"),
        F.lit(True).alias("has_subscription"),
    )


def paid_tenure(history: DataFrame, spells: DataFrame) -> DataFrame:
    """Per user: paid spells and days, open spells capped at the newest change of anyone."""
    newest = history.agg(F.max("valid_from")).scalar()
    days = days_between(F.col("paid_from"), F.least(F.col("paid_to"), newest))
    return (
        spells.withColumn("days", days)
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("paid_spell_count"),
            F.min("paid_from").alias("first_paid_at"),
            F.sum("days").alias("total_paid_days"),
        )
    )


def dim_user(users: DataFrame, history: DataFrame, spells: DataFrame) -> DataFrame:
    """One row per account, with its subscription state as flags and counts."""
    with_state = spine_rollup(
        users,
        subscription_state(history),
        "user_id",
        {
            "subscription_count": 0,
            "has_ever_paid": False,
            "has_ever_churned": False,
            "is_currently_subscribed": False,
            "current_usd_mrr": 0.0,
            "has_subscription": False,
        },
    )
    with_tenure = spine_rollup(
        with_state, paid_tenure(history, spells), "user_id", {"paid_spell_count": 0, "total_paid_days": 0}
    )
    return with_tenure.select(
        "user_id",
        "signup_at_utc",
        F.col("signup_at_utc").cast("date").alias("signup_date"),
        "home_state",
        "acquisition_channel",
        "subscription_count",
        "first_subscription_at",
        "latest_change_plan_type",
        "latest_change_status",
        "has_ever_paid",
        "has_ever_churned",
        "is_currently_subscribed",
        "current_usd_mrr",
        "paid_spell_count",
        "first_paid_at",
        "total_paid_days",
        "has_subscription",
    )
