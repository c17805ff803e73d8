"""Data checks. Each returns the failing rows; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyreel.operators.collapse import disagreeing_keys
from tallyreel.operators.intervals import overlapping_after_merge
from tallyreel.operators.lookups import orphans
from tallyreel.operators.split_window import HotGroups, Lead, ordered_columns
from tallyreel.profiling.keys import copies_per_key
from tallyreel.profiling.shared import row_count, stacked

# ------------------------------------------------------------------ row conditions


def null_value(column: str) -> Column:
    return F.col(column).isNull()


def unexpected_value(column: str, values: Sequence[object]) -> Column:
    """NULL passes: whether NULL is allowed is another check's question."""
    return ~F.col(column).isin(list(values))


def violates(expression: str) -> Column:
    """NULL passes as well."""
    return ~F.expr(expression)


# ------------------------------------------------------------------ generic checks


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(null_value(column))


def check_accepted_values(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    return df.filter(unexpected_value(column, values))


def check_expression(df: DataFrame, expression: str) -> DataFrame:
    return df.filter(violates(expression))


def check_unique(df: DataFrame, column: str) -> DataFrame:
    return check_unique_combination(df.filter(F.col(column).isNotNull()), [column])


def check_unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(row_count().alias("n_records")).filter("n_records > 1")


def check_relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    return orphans(child, parent.select(F.col(parent_column).alias(column)), column)


# ------------------------------------------------------------------ checks of whole tables


# Result columns of the whole-table checks below.
def assert_collapse_columns_agree(catalog: DataFrame) -> DataFrame:
    """Rows of one asset id must agree on every column the collapsed table carries.

    A NULL runtime takes a stand-in, or a NULL beside a value would read as agreement.
    """
    return disagreeing_keys(
        catalog,
        "asset_id",
        {
            "distinct_sports": F.col("sport"),
            "distinct_home_schools": F.col("home_school"),
            "distinct_away_schools": F.col("away_school"),
            "distinct_starts": F.col("scheduled_start_at_utc"),
            "distinct_durations": F.coalesce(F.col("duration_seconds"), F.lit(-1.0)),
        },
        "catalog_rows",
    )


def assert_duplicates_identical(events: DataFrame) -> DataFrame:
    """Copies of one event id must be equal in every other column; else dropping one is a choice."""
    versions = F.struct(*[c for c in events.columns if c != "event_id"])
    conflicting = copies_per_key(events, "event_id").filter("conflicting").select("event_id")
    # Only rows of offending ids are counted distinctly.
    return (
        events.join(conflicting, "event_id", "left_semi")
        .groupBy("event_id")
        .agg(row_count().alias("copies"), F.count_distinct(versions).alias("distinct_versions"))
    )


def _differ(left: str, right: str) -> Column:
    """Null-safe: a missing side is a failure, not an unknown."""
    return ~F.col(left).eqNullSafe(F.col(right))


def assert_row_reconciliation(raw: DataFrame, staged: DataFrame) -> DataFrame:
    """Staging drops exactly the surplus copies."""
    counted = raw.agg(
        row_count().alias("raw_rows"),
        (row_count() - F.count_distinct("event_id")).alias("expected_dupes_removed"),
    ).select("*", staged.agg(row_count()).scalar().alias("staged_rows"))
    return counted.withColumn("actual_rows_removed", F.col("raw_rows") - F.col("staged_rows")).filter(
        _differ("actual_rows_removed", "expected_dupes_removed")
    )


def assert_rowcount_equal(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Models that must neither lose nor gain rows. Counts from both sides meet in one small union."""
    counts = []
    for name, (raw, staged) in pairs.items():
        for side, df in (("raw_rows", raw), ("staged_rows", staged)):
            n = df.agg(row_count().alias("n"))
            values = [F.col("n") if s == side else F.lit(0) for s in ("raw_rows", "staged_rows")]
            counts.append(
                n.select(F.lit(name).alias("model_name"), values[0].alias("raw_rows"), values[1].alias("staged_rows"))
            )
    both = stacked(counts).groupBy("model_name").agg(
        F.sum("raw_rows").alias("raw_rows"), F.sum("staged_rows").alias("staged_rows")
    )
    return both.withColumn("row_delta", F.col("staged_rows") - F.col("raw_rows")).filter(
        _differ("raw_rows", "staged_rows")
    )


def assert_exclusions_reconcile(events: DataFrame, assets: DataFrame, sessions: DataFrame) -> DataFrame:
    """Sessions left out of the fact are exactly those without an asset or without a runtime.

    Events are reduced to (session, asset) before the join; the excluded ones are those with no
    match among the playable assets, so the two reasons need one join only.
    """
    playable = assets.filter(F.col("duration_seconds").isNotNull()).select(F.col("asset_id").alias("_known"))
    pairs = events.select("session_id", "asset_id").distinct()
    marked = pairs.join(playable, F.col("asset_id") == F.col("_known"), "left")
    per_session = marked.groupBy("session_id").agg(F.bool_or(F.col("_known").isNull()).alias("excluded"))
    counted = per_session.agg(
        F.count("session_id").alias("staged_sessions"), F.count_if("excluded").alias("expected_exclusions")
    ).select("*", sessions.agg(row_count()).scalar().alias("modelled_sessions"))
    return counted.withColumn(
        "actual_exclusions", F.col("staged_sessions") - F.col("modelled_sessions")
    ).filter(_differ("actual_exclusions", "expected_exclusions"))


def assert_windows_contiguous(history: DataFrame, hot: HotGroups | None = None) -> DataFrame:
    """Windows of one subscription tile its timeline."""
    followed = ordered_columns(
        history.select("subscription_id", "valid_from", "valid_to", "subscription_change_key"),
        ["subscription_id"],
        ["valid_from", "subscription_change_key"],
        {"next_from": Lead("valid_from")},
        hot,
    )
    return followed.filter(F.col("next_from").isNotNull() & _differ("valid_to", "next_from")).select(
        "subscription_id", "valid_from", "valid_to", "next_from"
    )


def assert_intervals_no_overlap(
    df: DataFrame, key: str, start: str, end: str, tie_break: str, hot: HotGroups | None = None
) -> DataFrame:
    """Merged intervals of one key are disjoint. A running maximum finds a failure wherever any
    pair overlaps, without forming pairs."""
    return overlapping_after_merge(df, key, start, end, [tie_break], hot)


def assert_spine_grain(fact: DataFrame, users: DataFrame, sessions: DataFrame) -> DataFrame:
    """One fact row per account, and every attributable session counted once."""
    attributable = F.col("user_id").isNotNull() & ~F.col("has_unknown_user")
    counted = fact.agg(
        row_count().alias("fact_rows"),
        F.count_distinct("user_id").alias("fact_users"),
        F.sum("session_count").alias("sessions_in_fact"),
    ).select(
        "*",
        users.agg(row_count()).scalar().alias("registered_users"),
        sessions.agg(F.count_if(attributable)).scalar().alias("attributable_sessions"),
    )
    return counted.filter(
        _differ("fact_rows", "registered_users")
        | _differ("fact_users", "registered_users")
        | _differ("sessions_in_fact", "attributable_sessions")
    )
