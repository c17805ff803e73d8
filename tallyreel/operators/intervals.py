"""Interval operators: merge, count overlaps, count containment, all per key. They sort; none forms pairs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyreel.operators.split_window import (
    HotGroups,
    PriorMax,
    RunningSum,
    carried_columns,
    find_hot_groups,
    ordered_columns,
    place_in_pieces,
)


def label_islands(
    df: DataFrame,
    key: str,
    start: str,
    end: str,
    tie_break: Sequence[str],
    label: str,
    hot: HotGroups | None = None,
) -> DataFrame:
    """Number the merged interval each row belongs to, per key and from one.

    A row opens a new island when it starts after the furthest end seen so far. The furthest end,
    not the previous one, keeps nested intervals together; the strict comparison keeps touching
    intervals together. Both passes share one order, hence one exchange and one sort; rows of hot
    groups are placed in pieces once for both.
    """
    order = [start, end, *tie_break]
    opens = F.when(F.col("_furthest").isNull() | (F.col(start) > F.col("_furthest")), 1).otherwise(0)

    def labelled(part: DataFrame, add: Callable[..., DataFrame]) -> DataFrame:
        reached = add(part, [key], order, {"_furthest": PriorMax(end)})
        flagged = reached.withColumn("_opens", opens.cast("bigint"))
        return add(flagged, [key], order, {label: RunningSum("_opens")}).drop("_furthest", "_opens")

    if hot is None:
        return labelled(df, ordered_columns)
    cold, placed = place_in_pieces(df, [key], order, hot)
    return labelled(cold, ordered_columns).unionByName(labelled(placed, carried_columns).drop("_piece"))


def merge_intervals(
    df: DataFrame,
    key: str,
    start: str,
    end: str,
    tie_break: Sequence[str],
    label: str,
    hot: HotGroups | None = None,
    **measures: Column,
) -> DataFrame:
    """One row per merged interval: key, running number, first start, last end, and measures.

    Rows of a key already lie together after the windows, so this adds no shuffle.
    """
    labelled = label_islands(df, key, start, end, tie_break, label, hot)
    return labelled.groupBy(key, label).agg(
        F.min(start).alias(start), F.max(end).alias(end), *[c.alias(n) for n, c in measures.items()]
    )


def overlapping_after_merge(
    df: DataFrame, key: str, start: str, end: str, tie_break: Sequence[str], hot: HotGroups | None = None
) -> DataFrame:
    """Rows that start before the furthest end of their predecessors: none, if rows are disjoint."""
    reached = ordered_columns(df, [key], [start, end, *tie_break], {"furthest_end": PriorMax(end)}, hot)
    return reached.filter(F.col(start) < F.col("furthest_end"))


def overlap_partners(
    df: DataFrame,
    key: str,
    ident: str,
    start: str,
    end: str,
    flag: str,
    closed: bool,
    hot: HotGroups | None = None,
) -> DataFrame:
    """Per interval, how many earlier-starting intervals of its key overlap it, by a flag.

    A sweep over starts and ends: a start adds one, an end takes one away, and the running sum
    before a start is the number of intervals still open. Every overlapping pair counts once, at
    the later of its two starts, in time n log n instead of one row per pair. ``closed`` counts
    intervals that share only an end point. Needs start <= end (closed) or start < end (open).
    """
    first, last = (0, 1) if closed else (1, 0)
    one, minus = F.lit(1).cast("bigint"), F.lit(-1).cast("bigint")
    points = df.select(
        key,
        ident,
        flag,
        F.explode(
            F.array(
                F.struct(F.col(start).alias("at"), F.lit(first).alias("kind"), one.alias("step")),
                F.struct(F.col(end).alias("at"), F.lit(last).alias("kind"), minus.alias("step")),
            )
        ).alias("p"),
    ).select(
        key,
        ident,
        flag,
        F.col("p.at").alias("at"),
        F.col("p.kind").alias("kind"),
        F.col("p.step").alias("step"),
        F.when(F.col(flag), F.col("p.step")).otherwise(0).cast("bigint").alias("step_flagged"),
    )
    swept = ordered_columns(
        points,
        [key],
        ["at", "kind", ident],
        {"open_all": RunningSum("step"), "open_flagged": RunningSum("step_flagged")},
        hot,
    ).filter(F.col("step") == 1)
    # The running sums include the row itself.
    return swept.select(
        key,
        ident,
        flag,
        (F.col("open_flagged") - F.col("step_flagged")).alias("flagged_partners"),
        (F.col("open_all") - 1 - (F.col("open_flagged") - F.col("step_flagged"))).alias("other_partners"),
    )


def containing_pairs(
    outer: DataFrame,
    inner: DataFrame,
    key: str,
    ident: str,
    outer_span: tuple[str, str],
    inner_span: tuple[str, str],
    hot: HotGroups | None = None,
) -> DataFrame:
    """(key, pairs): how often an outer span of the key strictly contains an inner one, start and end.

    Offline counting in two dimensions. Outer spans are ranked by end, and an inner span's end falls
    behind m of them. The ranks above m are the union of at most one dyadic block for each bit of
    m that is zero, so each outer span is posted in the blocks of its set bits and each inner span
    asks the blocks of its unset ones. Within a block a running count over starts answers. Rows grow by
    the logarithm of a key's spans instead of one for each pair.
    """
    (o_start, o_end), (i_start, i_end) = outer_span, inner_span
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def points(df: DataFrame, start: str, end: str, step: Column) -> DataFrame:
        # Ends of outer spans count before an equal inner end; at equal starts the inner span asks first.
        return df.select(key, F.col(ident).alias("_id"), F.col(start).alias("_start"), F.col(end).alias("_end"), step.alias("_step"))

    asked = inner.select(key).distinct()
    spans = points(outer.join(asked, key, "left_semi"), o_start, o_end, one).unionByName(points(inner, i_start, i_end, none))
    spans = spans.withColumn("_asks", 1 - F.col("_step"))
    ranked = ordered_columns(spans, [key], ["_end", "_asks", "_id"], {"_rank": RunningSum("_step")}, hot)
    most = ranked.agg(F.coalesce(F.max("_rank"), F.lit(0))).scalar()
    level = F.explode(F.sequence(F.lit(0), F.length(F.bin(most)) - 1))
    levelled = ranked.withColumn("_level", level)
    # Only odd blocks are ever asked for.
    block = F.expr("shiftright(_rank, _level) + _asks")
    levelled = levelled.withColumn("_block", block).filter("_block % 2 = 1")
    levelled = levelled.withColumn("_asks_first", -F.col("_asks"))
    blocks = [key, "_level", "_block"]
    wide = find_hot_groups(levelled, blocks, hot.max_rows) if hot is not None and hot.max_rows else None
    counted = ordered_columns(levelled, blocks, ["_start", "_asks_first", "_id"], {"_before": RunningSum("_step")}, wide)
    return counted.filter("_asks = 1").groupBy(key).agg(F.sum("_before").alias("pairs"))
