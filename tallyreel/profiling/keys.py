"""Keys: uniqueness, duplicates, orphans, fan-out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyreel.functions.cleaning import numeric_or_null
from tallyreel.operators.lookups import orphans
from tallyreel.profiling.shared import (
    joined_row_counts,
    one_row_to_many,
    repeated_key_rows,
    row_count,
    stacked,
)


def _distinct(columns: Sequence[str]) -> Column:
    """Distinct values of one column, or distinct tuples; a tuple with a NULL member counts."""
    return F.count_distinct(columns[0] if len(columns) == 1 else F.struct(*columns))


def key_uniqueness(candidates: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    """Rows, distinct values and surplus per candidate key."""
    return stacked(
        [
            df.agg(row_count().alias("rows"), _distinct(columns).alias("distinct_vals")).select(
                F.lit(label).alias("key"),
                "rows",
                "distinct_vals",
                (F.col("rows") - F.col("distinct_vals")).alias("surplus_rows"),
            )
            for label, df, columns in candidates
        ]
    )


def full_row_dupes(tables: Mapping[str, DataFrame]) -> DataFrame:
    return stacked(
        [
            df.agg((row_count() - F.count_distinct(F.struct(*df.columns))).alias("dupe_rows")).select(
                F.lit(name).alias("tbl"), "dupe_rows"
            )
            for name, df in tables.items()
        ]
    )


def fk_orphans_leftjoin(links: Sequence[tuple[str, DataFrame, DataFrame, str]]) -> DataFrame:
    """Rows and orphans as a left join counts them, fan-out included."""
    n, m = F.col("n"), F.col("m")
    return stacked(
        [
            joined_row_counts(child, parent, key)
            .agg(
                F.sum(n * F.coalesce(m, F.lit(1))).alias("child_rows"),
                F.sum(F.when(m.isNull(), n).otherwise(0)).alias("orphans"),
            )
            .select(F.lit(label).alias("fk"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("child_rows", "orphans")])
            for label, child, parent, key in links
        ]
    )


def fk_orphans_antijoin(links: Sequence[tuple[str, DataFrame, DataFrame, str]]) -> DataFrame:
    """Orphan rows and keys, each row counted once. Rows are combined per key before the join."""
    return stacked(
        [
            orphans(child.groupBy(key).agg(row_count().alias("n")), parent, key)
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"), row_count().alias("orphan_keys"))
            .select(F.lit(label).alias("fk"), "orphan_rows", "orphan_keys")
            for label, child, parent, key in links
        ]
    )


def fanout(child: DataFrame, parent: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """Row counts before, after an inner and after a left join."""
    n, m = F.col("n"), F.col("m")
    before, inner, left = names
    return joined_row_counts(child, parent, key).agg(
        F.coalesce(F.sum(n), F.lit(0)).alias(before),
        F.coalesce(F.sum(n * m), F.lit(0)).alias(inner),
        F.coalesce(F.sum(n * F.coalesce(m, F.lit(1))), F.lit(0)).alias(left),
    )


def duplicate_key_shape(catalog: DataFrame) -> DataFrame:
    """Which columns differ between rows of one asset id. Only repeated ids are expanded."""
    full = [c for c in catalog.columns if c != "asset_id"]
    return (
        repeated_key_rows(catalog, "asset_id")
        .groupBy("asset_id")
        .agg(
            row_count().alias("n_rows"),
            F.count_distinct("title").alias("n_titles"),
            F.count_distinct("asset_type").alias("n_types"),
            F.count_distinct("sport").alias("n_sports"),
            F.count_distinct("duration_seconds").alias("n_durations"),
            F.count_distinct(F.struct(*full)).alias("n_distinct_full_rows"),
        )
        .orderBy("asset_id")
    )


def copies_per_key(df: DataFrame, key: str) -> DataFrame:
    """Copies per key and whether they conflict.

    Smallest and largest row differ exactly when copies differ, and both combine on the map side,
    so a key with countless copies stays small.
    """
    row = F.struct(*[c for c in df.columns if c != key])
    return df.groupBy(key).agg(
        row_count().alias("copies"), (~F.min(row).eqNullSafe(F.max(row))).alias("conflicting")
    )


def duplicate_identity(events: DataFrame) -> DataFrame:
    conflicting = F.col("conflicting")
    return (
        copies_per_key(events, "event_id")
        .filter("copies > 1")
        .groupBy(F.col("copies").alias("n_rows_per_id"))
        .agg(
            row_count().alias("n_event_ids"),
            F.count_if(~conflicting).alias("ids_with_identical_rows"),
            F.count_if(conflicting).alias("ids_with_conflicting_rows"),
        )
        .orderBy("n_rows_per_id")
    )


def duplicated_assets(catalog: DataFrame) -> DataFrame:
    return repeated_key_rows(catalog, "asset_id").orderBy("asset_id", "title")


def ambiguous_playback(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """Events and sessions on asset ids that cover more than one catalog row."""
    repeated = catalog.groupBy("asset_id").agg(row_count().alias("n")).filter("n > 1")
    return events.join(repeated, "asset_id", "left_semi").agg(
        row_count().alias("events"), F.count_distinct("session_id").alias("sessions")
    )


def coverage(users: DataFrame, subscriptions: DataFrame, events: DataFrame) -> DataFrame:
    """Accounts in total, with a subscription, with playback: three one-row aggregates."""
    watched = events.filter(F.col("user_id").isNotNull() & (F.col("user_id") != ""))
    return users.agg(row_count().alias("users_total")).select(
        "users_total",
        subscriptions.agg(F.count_distinct("user_id")).scalar().alias("users_with_sub"),
        watched.agg(F.count_distinct("user_id")).scalar().alias("users_with_playback"),
    )


def numeric_sanity(columns: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Non-numeric, negative, smallest and largest value per text column."""
    by_table: dict[int, list[tuple[str, DataFrame, str]]] = {}
    for entry in columns:
        by_table.setdefault(id(entry[1]), []).append(entry)
    parts = []
    for entries in by_table.values():
        aggregates, rows = [], []
        for i, (label, _, column) in enumerate(entries):
            value = numeric_or_null(F.col(column))
            aggregates += [
                F.count_if(~F.col(column).rlike(r"\A-?[0-9.]+\z")).alias(f"odd{i}"),
                F.count_if(value < 0).alias(f"neg{i}"),
                F.min(value).alias(f"min{i}"),
                F.max(value).alias(f"max{i}"),
            ]
            rows.append(
                {
                    "col": F.lit(label),
                    "non_numeric": F.col(f"odd{i}"),
                    "negative": F.col(f"neg{i}"),
                    "min_val": F.col(f"min{i}"),
                    "max_val": F.col(f"max{i}"),
                }
            )
        parts.append(one_row_to_many(entries[0][1].agg(*aggregates), rows))
    return stacked(parts)
