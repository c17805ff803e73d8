"""Ordered per-group columns (previous, next, running) that survive a group of any size.

A plain window sorts a whole group inside one task. Here groups above a row limit are found first
(a map-side combined count), range-partitioned on (group, order) so that one group spreads over
many tasks, and written out by a reliable checkpoint, which fixes the piece numbers for good. Each
piece is windowed on its own; one summary row per piece is carried to the pieces after it. All
other groups take the plain window. Both ways give the same values.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyreel.sources.workspace import ensure_checkpoint_dir


# Keys of hot groups are broadcast up to this counted number; beyond it the planner decides. Plan only:
# results are the same either way.
BROADCAST_GROUPS = 10_000
# Sampled rows that a group at the limit has on average.
SAMPLED = 64


@dataclass(frozen=True)
class Lag:
    column: str


@dataclass(frozen=True)
class Lead:
    column: str


@dataclass(frozen=True)
class PriorMax:
    """Largest value over all rows before this one."""

    column: str


@dataclass(frozen=True)
class RunningSum:
    """Sum up to and including this row."""

    column: str


@dataclass(frozen=True)
class RowNumber:
    pass


Spec = Lag | Lead | PriorMax | RunningSum | RowNumber


@dataclass(frozen=True)
class HotGroups:
    """Groups above the row limit: at most total rows / limit of them."""

    keys: DataFrame
    columns: tuple[str, ...]
    pieces: int
    # The row limit itself, for groups that are derived from these.
    max_rows: int | None = None


def find_hot_groups(df: DataFrame, keys: Sequence[str], max_rows: int) -> HotGroups | None:
    """Count rows per group and keep the groups above ``max_rows``; None when there is none.

    Runs at once: the counts are written by one job, and read from there.
    """
    ensure_checkpoint_dir(df.sparkSession)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > max_rows).checkpoint()
    found = sizes.agg(F.count(F.lit(1)).alias("groups"), F.sum("_rows").alias("total")).first()
    if not found["groups"]:
        return None
    return _hot_groups(sizes.select(*keys), keys, found["groups"], found["total"], max_rows)


def find_hot_keys(
    df: DataFrame, keys: Mapping[str, tuple[str, str]], max_rows: int
) -> dict[str, HotGroups | None]:
    """Hot groups of several keys of one table: ``keys`` gives each a (column, type); None where a key has none.

    One pass over a sample of rows, in which a group at the limit has SAMPLED rows on average, counts all
    keys together and keeps what has an eighth of that: a hot group is missed once in 10^18 times, and
    then only meets in one task. The few kept ones are counted exactly over all rows in a second pass,
    which is left out where nothing was kept. Below SAMPLED rows the sample is the table, and exact.
    """
    ensure_checkpoint_dir(df.sparkSession)
    values = [
        F.struct(F.lit(name).alias("name"), F.col(column).try_cast(kind).cast("string").alias("value"))
        for name, (column, kind) in keys.items()
    ]
    share = min(1.0, SAMPLED / max_rows)

    def tagged(rows: DataFrame) -> DataFrame:
        return rows.select(F.explode(F.array(*values)).alias("k")).select("k.name", "k.value")

    def sizes(rows: DataFrame, more_than: float) -> DataFrame:
        counted = rows.groupBy("name", "value").agg(F.count(F.lit(1)).alias("_rows"))
        return counted.filter(F.col("_rows") > more_than).checkpoint()

    if share == 1:
        found = sizes(tagged(df), max_rows)
    else:
        found = sizes(tagged(df.sample(share, seed=1)), SAMPLED / 8)
        if found.take(1):
            same = _same_keys("r", "c", [("name", "name"), ("value", "value")])
            found = sizes(tagged(df).alias("r").join(found.alias("c"), same, "left_semi"), max_rows)
    totals = found.groupBy("name").agg(F.count(F.lit(1)).alias("groups"), F.sum("_rows").alias("total")).collect()
    hot: dict[str, HotGroups | None] = dict.fromkeys(keys)
    for row in totals:
        column, kind = keys[row["name"]]
        mine = found.filter(F.col("name") == row["name"]).select(F.col("value").cast(kind).alias(column))
        hot[row["name"]] = _hot_groups(mine, [column], row["groups"], row["total"], max_rows)
    return hot


def _hot_groups(keys: DataFrame, columns: Sequence[str], groups: int, total: int, max_rows: int) -> HotGroups:
    if groups <= BROADCAST_GROUPS:
        keys = F.broadcast(keys)
    # Twice as many pieces as strictly needed, since range bounds come from a sample.
    return HotGroups(keys, tuple(columns), max(2, math.ceil(2 * total / max_rows)), max_rows)


def _same_keys(left: str, right: str, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(
        lambda a, b: a & b,
        [F.col(f"{left}.{a}").eqNullSafe(F.col(f"{right}.{b}")) for a, b in pairs],
    )


def ascending(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def _over(spec: Spec, window) -> Column:
    if isinstance(spec, Lag):
        return F.lag(spec.column).over(window)
    if isinstance(spec, Lead):
        return F.lead(spec.column).over(window)
    if isinstance(spec, PriorMax):
        return F.max(spec.column).over(window.rowsBetween(Window.unboundedPreceding, -1))
    if isinstance(spec, RunningSum):
        return F.sum(spec.column).over(window.rowsBetween(Window.unboundedPreceding, 0))
    return F.row_number().over(window).cast("bigint")


def ordered_columns(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    new: Mapping[str, Spec],
    hot: HotGroups | None = None,
) -> DataFrame:
    """Add window columns per group. ``order`` should end in a unique column."""

    def plain(part: DataFrame) -> DataFrame:
        window = Window.partitionBy(*keys).orderBy(*ascending(order))
        return part.withColumns({name: _over(spec, window) for name, spec in new.items()})

    if hot is None:
        return plain(df)
    cold_rows, placed = place_in_pieces(df, keys, order, hot)
    return plain(cold_rows).unionByName(carried_columns(placed, keys, order, new).drop("_piece"))


def place_in_pieces(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], hot: HotGroups
) -> tuple[DataFrame, DataFrame]:
    """Rows of all other groups, and rows of hot groups with a column ``_piece``.

    Piece numbers rise with the order inside a group. The reliable checkpoint keeps them: range
    bounds come from a sample, so a recomputed plan could cut elsewhere.
    """
    match = _same_keys("d", "h", list(zip(keys, hot.columns, strict=True)))
    cold_rows = df.alias("d").join(hot.keys.alias("h"), match, "left_anti")
    hot_rows = df.alias("d").join(hot.keys.alias("h"), match, "left_semi")
    ensure_checkpoint_dir(df.sparkSession)
    ranged = hot_rows.repartitionByRange(hot.pieces, *[F.col(k) for k in keys], *ascending(order))
    return cold_rows, ranged.withColumn("_piece", F.spark_partition_id()).checkpoint()


def carried_columns(
    placed: DataFrame, keys: Sequence[str], order: Sequence[str], new: Mapping[str, Spec]
) -> DataFrame:
    """Window each piece on its own, then bring in what the pieces before (or after) it know.

    Takes rows from ``place_in_pieces`` and keeps their ``_piece``, so one placing serves several passes.
    """
    columns = placed.columns
    inside = Window.partitionBy(*keys, "_piece").orderBy(*ascending(order))
    local = placed.withColumns(
        {
            **{name: _over(spec, inside) for name, spec in new.items()},
            "_first": F.lag(F.lit(True)).over(inside).isNull(),
            "_last": F.lead(F.lit(True)).over(inside).isNull(),
        }
    )

    key_names = [f"_k{i}" for i in range(len(keys))]
    renamed = [F.col(k).alias(n) for k, n in zip(keys, key_names, strict=True)]
    across = Window.partitionBy(*key_names).orderBy("_p")
    before = across.rowsBetween(Window.unboundedPreceding, -1)

    # One row per piece of a group: what later (or earlier) pieces need to know about it.
    tail_values, tail_carry, head_values, head_carry = [], {}, [], {}
    for i, (name, spec) in enumerate(new.items()):
        value, carry = f"_v{i}", f"_c{i}"
        if isinstance(spec, Lead):
            head_values.append(F.col(spec.column).alias(value))
            head_carry[carry] = F.lead(value).over(across)
        elif isinstance(spec, Lag):
            tail_values.append(F.col(spec.column).alias(value))
            tail_carry[carry] = F.lag(value).over(across)
        elif isinstance(spec, PriorMax):
            tail_values.append(F.greatest(F.col(name), F.col(spec.column)).alias(value))
            tail_carry[carry] = F.max(value).over(before)
        else:
            tail_values.append(F.col(name).alias(value))
            tail_carry[carry] = F.sum(value).over(before)

    result = local.alias("l")
    pairs = [*zip(keys, key_names, strict=True), ("_piece", "_p")]
    for edge, values, carries in (("_last", tail_values, tail_carry), ("_first", head_values, head_carry)):
        if values:
            summary = local.filter(edge).select(*renamed, F.col("_piece").alias("_p"), *values)
            carried = summary.withColumns(carries).select(*key_names, "_p", *carries)
            result = (
                result.join(carried.alias("r"), _same_keys("l", "r", pairs), "left")
                .drop(*key_names, "_p")
                .alias("l")
            )

    final = {}
    for i, (name, spec) in enumerate(new.items()):
        own, carried = F.col(name), F.col(f"_c{i}")
        if isinstance(spec, Lag):
            final[name] = F.when(F.col("_first"), carried).otherwise(own)
        elif isinstance(spec, Lead):
            final[name] = F.when(F.col("_last"), carried).otherwise(own)
        elif isinstance(spec, PriorMax):
            final[name] = F.greatest(own, carried)
        else:
            final[name] = F.coalesce(own + carried, own, carried)
    return result.withColumns(final).select(*columns, *new)
