"""Temporal range join against a rate table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Up to so many periods a key, trying each of them makes at most twice as many candidates as rows.
FEW_PERIODS = 2


def has_many_periods(rates: DataFrame, key: str) -> bool:
    """Whether some key has more than FEW_PERIODS periods."""
    return bool(rates.groupBy(key).count().filter(F.col("count") > FEW_PERIODS).take(1))


def _level(days: Column) -> Column:
    """Floor of log2 of a positive number."""
    return F.length(F.bin(days)) - 1


def covering_periods(days: DataFrame, periods: DataFrame, keep: list[str]) -> DataFrame:
    """(_rate_key, _day, *keep) for each pair of a day and a period of its key that covers it.

    Interval index: a period of 2^n days or more, but fewer than 2^(n+1), stands in bins of 2^(n-1)
    days, five at most. A day asks one bin of each length that its key has, so of periods that do not
    overlap it meets one and a half on average, whatever their number.
    """
    sized = periods.filter("_from <= _to").withColumn("_level", _level(F.col("_to") - F.col("_from") + 1))

    def bin_of(day: str) -> Column:
        return F.expr(f"floor({day} / shiftleft(1, greatest(_level - 1, 0)))")

    posted = sized.withColumn("_bin", F.explode(F.sequence(bin_of("_from"), bin_of("_to"))))
    levels = sized.select("_rate_key", "_level").distinct()
    asked = days.join(levels, "_rate_key").withColumn("_bin", bin_of("_day"))
    met = asked.join(posted, ["_rate_key", "_level", "_bin"]).filter("_day between _from and _to")
    return met.select("_rate_key", "_day", *keep)


def temporal_rate_join(
    df: DataFrame,
    rates: DataFrame,
    key: str,
    on_date: str,
    keep: list[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    many_periods: bool | None = None,
) -> DataFrame:
    """Left join to the rates whose inclusive period covers the date; no rate gives NULL.

    Where a key has many periods (``many_periods``; looked up if not given), the periods of the
    different (key, date) pairs are found first, through an interval index, and rows join them on
    equality. Otherwise rows try the one or two periods of their key.

    No broadcast hint: the planner broadcasts the rates while they are below its size threshold
    and otherwise sort-merges on the key, where AQE splits an over-full key such as a main
    currency. The key stays a column, since a literal would turn this into a nested loop.
    """
    if has_many_periods(rates, key) if many_periods is None else many_periods:
        periods = rates.select(
            F.col(key).alias("_rate_key"), F.unix_date(valid_from).alias("_from"), F.unix_date(valid_to).alias("_to"), *keep
        )
        days = df.select(F.col(key).alias("_rate_key"), F.unix_date(on_date).alias("_day")).dropna().distinct()
        found = covering_periods(days, periods, keep)
        same = (F.col(key) == F.col("_rate_key")) & (F.unix_date(on_date) == F.col("_day"))
        return df.join(found, same, "left").drop("_rate_key", "_day")
    periods = rates.select(
        F.col(key).alias("_rate_key"),
        F.col(valid_from).alias("_from"),
        F.col(valid_to).alias("_to"),
        *keep,
    )
    covers = (F.col(key) == F.col("_rate_key")) & F.col(on_date).between(F.col("_from"), F.col("_to"))
    return df.join(periods, covers, "left").drop("_rate_key", "_from", "_to")
