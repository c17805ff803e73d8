"""Joins against a key list: keep matches, keep orphans, or flag orphans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_known(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Orphan filter. A semi join cannot fan out, whatever the key list holds."""
    return df.join(known.select(key), key, "left_semi")


def orphans(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose non-NULL key is unknown. An anti join, so a NULL in the list hides nothing."""
    return df.filter(F.col(key).isNotNull()).join(known.select(key), key, "left_anti")


def flag_unknown(df: DataFrame, known: DataFrame, key: str, spread: str, flag: str) -> DataFrame:
    """Add a flag for rows whose key is set but not in the (unique) key list.

    NULL keys never match, yet would all hash to one task. A second key column spreads them by
    another column's hash; for set keys it repeats the key, so matches still meet.
    """
    left = df.withColumn("_spread", F.coalesce(F.col(key).cast("bigint"), F.xxhash64(spread)))
    right = known.select(
        F.col(key).alias("_known"), F.coalesce(F.col(key).cast("bigint"), F.lit(0)).alias("_known_spread")
    )
    match = (F.col(key) == F.col("_known")) & (F.col("_spread") == F.col("_known_spread"))
    return (
        left.join(right, match, "left")
        .withColumn(flag, F.col(key).isNotNull() & F.col("_known").isNull())
        .drop("_spread", "_known", "_known_spread")
    )
