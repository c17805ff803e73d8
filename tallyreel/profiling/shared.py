"""Shapes the profiles share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyreel.functions.numeric import percent


def stacked(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_count() -> Column:
    return F.count(F.lit(1))


def with_share(counted: DataFrame, count: str, digits: int, name: str = "pct") -> DataFrame:
    """Share of the total. The un-keyed window is safe here: callers pass a few labelled bands."""
    total = F.sum(count).over(Window.partitionBy())
    return counted.withColumn(name, percent(F.col(count), total, digits))


def one_row_to_many(row: DataFrame, entries: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Turn the columns of a single aggregate row into several result rows."""
    structs = [F.struct(*[c.alias(n) for n, c in entry.items()]) for entry in entries]
    return row.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def top(df: DataFrame, order: Sequence[Column], limit: int) -> DataFrame:
    return df.orderBy(*order).limit(limit)


def joined_row_counts(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows per key on both sides: what a row-level join would return, without performing it.

    Both sides are combined per key before they meet, so neither a hot key nor the fan-out of a
    repeated parent key ever exists as rows. Columns: n (child rows), m (parent rows or NULL).
    """
    left = child.groupBy(key).agg(row_count().alias("n"))
    right = parent.groupBy(key).agg(row_count().alias("m"))
    return left.join(right, key, "left").select("n", "m")


def repeated_key_rows(df: DataFrame, key: str) -> DataFrame:
    """All rows whose key occurs more than once, a NULL key included."""
    repeated = df.groupBy(key).agg(row_count().alias("_n")).filter("_n > 1").select(F.col(key).alias("_k"))
    return df.join(repeated, F.col(key).eqNullSafe(F.col("_k")), "left_semi")
