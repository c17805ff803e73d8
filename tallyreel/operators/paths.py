"""Ordered text path per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyreel.operators.split_window import HotGroups, RowNumber, ordered_columns, place_in_pieces


def ordered_paths(
    df: DataFrame,
    key: str,
    value: str,
    order: Sequence[str],
    separator: str,
    name: str,
    hot: HotGroups | None = None,
) -> DataFrame:
    """One string per key: its values in order. NULL values are left out.

    A hot group is sorted and joined to text piece by piece; the last step only joins the pieces'
    texts, which is no more than the resulting string itself.
    """
    within = ", ".join(f"`{c}` ASC NULLS LAST" for c in order)

    def path(text: str, by: str, alias: str):
        return F.expr(f"listagg({text}, '{separator}') WITHIN GROUP (ORDER BY {by})").alias(alias)

    if hot is None:
        return df.groupBy(key).agg(path(value, within, name))
    cold_rows, placed = place_in_pieces(df.select(key, value, *[c for c in order if c != value]), [key], order, hot)
    parts = placed.groupBy(key, "_piece").agg(path(value, within, "_text"))
    joined = parts.groupBy(key).agg(path("_text", "`_piece`", name))
    return cold_rows.groupBy(key).agg(path(value, within, name)).unionByName(joined)


class PathCollision(Exception):
    """Two different paths share a fingerprint."""


def counted_paths(
    df: DataFrame,
    key: str,
    value: str,
    order: Sequence[str],
    separator: str,
    name: str,
    count_name: str,
    hot: HotGroups | None = None,
    spell_bytes: int = 1 << 30,
) -> DataFrame:
    """How many keys have each path, as grouping ``ordered_paths`` by its text would say.

    With hot groups no grouping holds a path: a path is known by its length and two 64-bit sums of the
    hashes of its (place, value) pairs, which add up in any order and on any machine. That no two different
    paths share them is checked place by place. Only one path of each group is spelled out, and one
    above ``spell_bytes`` only by its length and fingerprint.
    """
    if hot is None:
        paths = ordered_paths(df, key, value, order, separator, name)
        return paths.groupBy(name).agg(F.count(F.lit(1)).alias(count_name))
    rows = df.select(F.col(key).alias("_key"), F.col(value).alias("_value"), *order)
    rows = rows.withColumn("_missing", F.col("_value").isNull())
    hot = HotGroups(hot.keys.withColumnRenamed(hot.columns[0], "_key"), ("_key",), hot.pieces)
    # NULL values come last, so that the others are numbered without gaps.
    placed = ordered_columns(rows, ["_key"], ["_missing", *order], {"_place": RowNumber()}, hot)
    placed = placed.select("_key", F.when(~F.col("_missing"), F.col("_place")).alias("_place"), "_value").checkpoint()
    print_of = ["_values", "_one", "_other"]

    def mixed(*parts) -> Column:
        return F.coalesce(F.bit_xor(F.when(F.col("_place").isNotNull(), F.xxhash64(*parts))), F.lit(0).cast("bigint"))

    prints = placed.groupBy("_key").agg(
        F.count("_place").alias("_values"),
        mixed("_place", "_value").alias("_one"),
        mixed(F.lit("second"), "_value", "_place").alias("_other"),
        F.coalesce(F.sum(F.octet_length("_value")), F.lit(0)).alias("_bytes"),
    )
    prints = prints.checkpoint()
    spelled_out = placed.filter("_place is not null").alias("r").join(prints.alias("p"), F.expr("r._key <=> p._key"))
    differing = spelled_out.groupBy(*print_of, "_place").agg(F.min("_value").alias("lo"), F.max("_value").alias("hi")).filter("lo <> hi")
    if differing.take(1):
        raise PathCollision(f"paths of {key} cannot be told apart by their fingerprints")
    groups = prints.groupBy(*print_of).agg(
        F.count(F.lit(1)).alias(count_name), F.min(F.struct("_bytes", "_key")).alias("_first")
    )
    size = F.col("_first._bytes") + F.octet_length(F.lit(separator)) * F.greatest(F.col("_values") - 1, F.lit(0))
    groups = groups.withColumn("_short", size <= spell_bytes)
    chosen = groups.filter("_short and _values > 0").select("_first._key")
    texts = ordered_paths(
        df.join(chosen, F.col(key).eqNullSafe(F.col("_key")), "left_semi"),
        key, value, order, separator, name, HotGroups(hot.keys.withColumnRenamed("_key", key), (key,), hot.pieces),
    ).withColumnRenamed(key, "_k")
    long = F.concat(F.col("_values"), F.lit(" values, fingerprint "), F.hex("_one"), F.hex("_other"))
    shown = groups.join(texts, F.col("_first._key").eqNullSafe(F.col("_k")) & F.col("_short") & (F.col("_values") > 0), "left")
    return shown.select(F.when(F.col("_short"), F.col(name)).otherwise(long).alias(name), count_name)
