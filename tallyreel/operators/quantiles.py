"""Exact interpolated quantiles without holding all values in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 200


def exact_quantiles(
    df: DataFrame, group: str, value: str, fractions: Sequence[float], few_groups: bool = False
) -> DataFrame:
    """Long result: one row per group and fraction, linear interpolation between order statistics.

    Values are first combined to (group, value, count). Sketched edges cut each group's distinct
    values into buckets; since any monotone cut is right, the sketch affects balance only, never
    the result. Bucket totals give each bucket its start rank. Only the few buckets that hold a
    wanted rank are sorted, each with about 1/200 of its group's distinct values.

    ``few_groups`` states that the groups are a handful of labels set by the caller. Their edges and
    starts (one row a group, two rows a group and fraction) are then sent to all tasks, so that the
    values are not shuffled by group, where they would meet in as many tasks as there are labels.
    """
    small = F.broadcast if few_groups else lambda table: table
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(group, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
        # Always true. It keeps the count in all three uses below, so that they share one aggregation.
        .filter("_n > 0")
    )
    edges = counts.groupBy(F.col(group).alias("_eg")).agg(
        F.percentile_approx("_v", [i / BUCKETS for i in range(1, BUCKETS)], 10_000).alias("_edges")
    )
    bucket = F.size(F.filter(F.col("_edges"), lambda edge: edge < F.col("_v")))
    placed = counts.join(small(edges), F.col(group).eqNullSafe(F.col("_eg"))).select(
        group, "_v", "_n", bucket.alias("_b")
    )

    def ranks(q: float) -> tuple[Column, Column]:
        position = (F.col("_total") - 1) * F.lit(float(q))
        return F.floor(position), F.ceil(position)

    def covers(start: Column, rows: Column, rank: Column) -> Column:
        return (start <= rank) & (rank < start + rows)

    per_group = Window.partitionBy("_sg")
    start = F.sum("_bn").over(per_group.orderBy("_sb").rowsBetween(Window.unboundedPreceding, -1))
    wanted = reduce(
        lambda a, b: a | b,
        [covers(F.col("_start"), F.col("_bn"), rank) for q in fractions for rank in ranks(q)],
    )
    starts = (
        placed.groupBy(F.col(group).alias("_sg"), F.col("_b").alias("_sb"))
        .agg(F.sum("_n").alias("_bn"))
        .withColumns({"_start": F.coalesce(start, F.lit(0)), "_total": F.sum("_bn").over(per_group)})
        .filter(wanted)
        .drop("_bn")
    )
    inside = Window.partitionBy(group, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        placed.join(small(starts), F.col(group).eqNullSafe(F.col("_sg")) & (F.col("_b") == F.col("_sb")))
        .withColumn("_before", F.col("_start") + F.sum("_n").over(inside) - F.col("_n"))
        .select(group, "_v", "_n", "_total", "_before")
    )
    aggregates = []
    for i, q in enumerate(fractions):
        for side, rank in zip(("lo", "hi"), ranks(q), strict=True):
            here = covers(F.col("_before"), F.col("_n"), rank)
            aggregates.append(F.max(F.when(here, F.col("_v"))).alias(f"_{side}{i}"))
    found = ranked.groupBy(group).agg(F.max("_total").alias("_total"), *aggregates)
    rows = []
    for i, q in enumerate(fractions):
        position = (F.col("_total") - 1) * F.lit(float(q))
        share = position - F.floor(position)
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        rows.append(
            F.struct(F.lit(float(q)).alias("quantile"), (low + (high - low) * share).alias("value"))
        )
    return found.select(group, F.explode(F.array(*rows)).alias("_q")).select(group, "_q.quantile", "_q.value")
