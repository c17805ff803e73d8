"""Threshold classification and ordered bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def classify_threshold(ratio: Column, cuts: Sequence[tuple[float, str]], top: str) -> Column:
    """Label by the first cut the ratio stays below. A NULL ratio takes the top label."""
    expr = None
    for cut, name in cuts:
        below = ratio < F.lit(cut)
        expr = F.when(below, F.lit(name)) if expr is None else expr.when(below, F.lit(name))
    return expr.otherwise(F.lit(top))


def bucketize_labels(bands: Sequence[tuple[Column, str]], other: str) -> Column:
    """First band whose condition holds names the row; NULL conditions fall through."""
    expr = None
    for condition, name in bands:
        expr = F.when(condition, F.lit(name)) if expr is None else expr.when(condition, F.lit(name))
    return expr.otherwise(F.lit(other))
