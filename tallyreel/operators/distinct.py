"""Several exact distinct counts of the same groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_counts(
    df: DataFrame,
    by: Sequence[str],
    counted: Mapping[str, str],
    conditions: Mapping[str, Column],
) -> DataFrame:
    """Per group: distinct values of columns (result name -> column), and rows that meet conditions.

    Two distinct counts in one aggregation multiply every row. Here rows first shrink to the distinct
    tuples of group and counted columns, combined on the map side, with the row counts carried along;
    only tuples are multiplied. Where the counted columns hang together (a session has one user and
    one asset), there are about as many tuples as values of the finest column. NULLs are not counted.
    Where ``df`` is laid out by one of the columns, the tuples need no exchange.
    """
    columns = list(dict.fromkeys([*by, *counted.values()]))
    carried = {name: f"_n{i}" for i, name in enumerate(conditions)}
    carry = [F.count_if(c).alias(carried[n]) for n, c in conditions.items()]
    tuples = df.groupBy(*columns).agg(*carry) if carry else df.select(*columns).distinct()
    return tuples.groupBy(*by).agg(
        *[F.count_distinct(column).alias(name) for name, column in counted.items()],
        *[F.coalesce(F.sum(carried[n]), F.lit(0)).alias(n) for n in conditions],
    )
