"""Attach pre-aggregated measures to a spine of entities."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spine_rollup(
    spine: DataFrame, measures: DataFrame, key: str, fill: Mapping[str, object]
) -> DataFrame:
    """Left join measures that are unique per key; absent ones take the fill value or stay NULL.

    Zero is a measurement (no sessions), NULL is its absence (no completion), so only the named
    columns are filled.
    """
    joined = spine.join(measures, key, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()})
