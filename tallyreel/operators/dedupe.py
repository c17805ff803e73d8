"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyreel.operators.split_window import ascending


def dedupe_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in the given order; the other columns break ties, so reruns agree.

    ``row_number() = 1`` lets Catalyst put a group limit in front of the shuffle: each map task
    forwards one row per key, so a key with countless copies reaches its task as one row per
    map task.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    window = Window.partitionBy(*key).orderBy(*ascending([*order, *rest]))
    return df.withColumn("_pick", F.row_number().over(window)).filter("_pick = 1").drop("_pick")
