"""Collapse rows that share an id down to the columns on which they agree."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def collapse_agreeing(
    df: DataFrame, key: str, agree: Sequence[str], any_true: Sequence[str] = ()
) -> DataFrame:
    """One row per key. ``max`` only deduplicates while D1 (disagreeing_keys) finds nothing."""
    return df.groupBy(key).agg(
        *[F.max(c).alias(c) for c in agree],
        *[F.bool_or(c).alias(c) for c in any_true],
        F.count(F.lit(1)).alias("source_row_count"),
        (F.count(F.lit(1)) > 1).alias("has_ambiguous_identity"),
    )


def disagreeing_keys(
    df: DataFrame, key: str, columns: Mapping[str, Column], rows_name: str = "rows"
) -> DataFrame:
    """Keys whose rows hold more than one value in any column, with the distinct counts.

    min <> max finds the offending keys in one map-side combined pass; only their rows are then
    counted distinctly, instead of expanding the whole table once per column.
    """
    named = df.select(key, *[c.alias(name) for name, c in columns.items()])
    spread = None
    for name in columns:
        differs = F.min(name) != F.max(name)
        spread = differs if spread is None else spread | differs
    offenders = named.groupBy(key).agg(F.coalesce(spread, F.lit(False)).alias("_spread")).filter("_spread")
    return (
        named.join(offenders.select(key), key, "left_semi")
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias(rows_name),
            *[F.count_distinct(F.col(name)).alias(name) for name in columns],
        )
    )
