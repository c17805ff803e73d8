"""Marts that state an opinion: what an engaged view is, and who is an engaged user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyreel.config import EngineConfig
from tallyreel.functions.numeric import steady_mean
from tallyreel.operators.classify import bucketize_labels, classify_threshold
from tallyreel.operators.spine import spine_rollup

# Tier names.
ABANDONED, SAMPLED, ENGAGED, NEVER_WATCHED = "abandoned", "sampled", "engaged", "never_watched"


def engaged_flag(config: EngineConfig) -> Column:
    return F.col("completion_pct") >= F.lit(config.engaged_min_completion)


def fct_session_engagement(sessions: DataFrame, config: EngineConfig) -> DataFrame:
    """One row per session: the completion ratio against the thresholds."""
    cuts = [(config.sampled_min_completion, ABANDONED), (config.engaged_min_completion, SAMPLED)]
    return sessions.select(
        "session_id",
        "user_id",
        "asset_id",
        "session_date",
        "completion_pct",
        engaged_flag(config).alias("is_engaged_view"),
        classify_threshold(F.col("completion_pct"), cuts, ENGAGED).alias("engagement_tier"),
    )


def classified_sessions(sessions: DataFrame, engagement: DataFrame) -> DataFrame:
    """Sessions with their stored classification, one row on both sides."""
    return sessions.join(engagement.select("session_id", "is_engaged_view"), "session_id")


def user_measures(sessions: DataFrame) -> DataFrame:
    """Per identified user. Anonymous sessions have nobody to be counted for; dropping them first
    also removes the one key that would gather a large share of all rows."""
    engaged = F.col("is_engaged_view")
    return (
        sessions.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("session_count"),
            F.count_if(engaged).alias("engaged_session_count"),
            F.count_distinct("asset_id").alias("distinct_assets_watched"),
            F.sum("watch_minutes").alias("total_watch_minutes"),
            F.sum(F.when(engaged, F.col("watch_minutes")).otherwise(0)).alias("engaged_watch_minutes"),
            F.max("completion_pct").alias("best_completion_pct"),
            steady_mean(F.col("completion_pct")).alias("avg_completion_pct"),
            F.min("session_start_at_utc").alias("first_session_at"),
            F.max("session_end_at_utc").alias("last_session_at"),
            F.count_distinct(F.col("session_start_at_utc").cast("date")).alias("active_days"),
            F.count_distinct("sport").alias("distinct_sports_watched"),
        )
    )


def fct_user_engagement(
    users: DataFrame, sessions: DataFrame, config: EngineConfig, engagement: DataFrame | None = None
) -> DataFrame:
    """One row per account, watched or not.

    A stored classification is joined; without one the flag is computed in place, which spares a
    join of two copies of the same session rows.
    """
    if engagement is None:
        classified = sessions.withColumn("is_engaged_view", engaged_flag(config))
    else:
        classified = classified_sessions(sessions, engagement)
    counts = [
        "session_count",
        "engaged_session_count",
        "distinct_assets_watched",
        "distinct_sports_watched",
        "total_watch_minutes",
        "engaged_watch_minutes",
        "active_days",
    ]
    joined = spine_rollup(users, user_measures(classified), "user_id", dict.fromkeys(counts, 0))
    tier = bucketize_labels(
        [
            (F.col("session_count") == 0, NEVER_WATCHED),
            (F.col("engaged_session_count") > 0, ENGAGED),
            (F.col("best_completion_pct") >= F.lit(config.sampled_min_completion), SAMPLED),
        ],
        ABANDONED,
    )
    return joined.select(
        "user_id",
        "signup_date",
        "home_state",
        "acquisition_channel",
        *counts,
        "best_completion_pct",
        "avg_completion_pct",
        "first_session_at",
        "last_session_at",
        (F.col("engaged_session_count") > 0).alias("is_engaged_user"),
        tier.alias("engagement_tier"),
        "has_subscription",
        "subscription_count",
        "latest_change_plan_type",
        "latest_change_status",
        "has_ever_paid",
        "has_ever_churned",
        "is_currently_subscribed",
        "current_usd_mrr",
        "paid_spell_count",
        "total_paid_days",
        "first_paid_at",
        (F.col("has_ever_paid") & ~F.col("is_currently_subscribed")).alias("has_churned_from_paid"),
    )
