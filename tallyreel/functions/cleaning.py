"""Reusable cleaning expressions. Each takes columns and returns a column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator and NULL stand-in of the surrogate key text.
KEY_SEPARATOR = "-"
KEY_NULL = "<null>"

# Category spellings that upper-casing alone does not repair.
SPORT_ALIASES = {"BBALL": "BASKETBALL", "VB": "VOLLEYBALL", "FB": "FOOTBALL"}
STATE_ALIASES = {"FLORIDA": "FL", "TEXAS": "TX", "GEORGIA": "GA", "GA.": "GA"}

# Months one billing period covers, and the suffix of a replay title.
BILLING_MONTHS = {"monthly": 1, "annual": 12, "free_trial": 0}
REPLAY_PATTERN = "%(Replay)"


def surrogate_key(columns: Sequence[Column]) -> Column:
    """Deterministic md5 over a column list. NULLs get a stand-in, since concat_ws drops them."""
    parts = [F.coalesce(c.cast("string"), F.lit(KEY_NULL)) for c in columns]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def map_category(value: Column, aliases: Mapping[str, str]) -> Column:
    """Trim, upper-case, translate the listed spellings, pass everything else through."""
    cleaned = F.upper(F.trim(value))
    expr = None
    for spelling, name in aliases.items():
        branch = cleaned == F.lit(spelling)
        expr = F.when(branch, F.lit(name)) if expr is None else expr.when(branch, F.lit(name))
    return cleaned if expr is None else expr.otherwise(cleaned)


def null_out_below(value: Column, minimum: float) -> Column:
    """Impossible measurements become NULL, so that a ratio over them is NULL as well."""
    return F.when(value < F.lit(minimum), F.lit(None)).otherwise(value)


def is_below(value: Column, minimum: float) -> Column:
    """Flag beside null_out_below; NULL in, NULL out."""
    return value < F.lit(minimum)


def replay_flag(title: Column) -> Column:
    return F.trim(title).like(REPLAY_PATTERN)


def billing_months(plan: Column) -> Column:
    expr = None
    for name, months in BILLING_MONTHS.items():
        branch = plan == F.lit(name)
        expr = F.when(branch, F.lit(months)) if expr is None else expr.when(branch, F.lit(months))
    return expr


# Text of whole numbers, and of numbers at large. A plain cast to double would also take the type
# suffixes and hexadecimal forms of the JVM ('1d', '2.5f', '0x1p3').
WHOLE_NUMBER = r"\A\s*[+-]?[0-9]+\s*\z"
POINT_NUMBER = r"\A\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"
NAMED_NUMBER = r"(?i)\A\s*[+-]?(nan|inf|infinity)\s*\z"


def _not_a_number(text: Column, kind: str) -> Column:
    return F.raise_error(F.concat(F.lit("not a number: "), text)).cast(kind)


def whole_number(text: Column, kind: str = "bigint") -> Column:
    """Hard cast to an integer type. Text with a point or exponent is rounded half away from zero.

    The rounding goes through a decimal, so ids beyond 2^53 stay exact. Anything else fails the run.
    """
    rounded = F.round(text.cast("decimal(38, 10)"), 0).cast(kind)
    return (
        F.when(text.isNull() | text.rlike(WHOLE_NUMBER), text.cast(kind))
        .when(text.rlike(POINT_NUMBER), rounded)
        .otherwise(_not_a_number(text, kind))
    )


def _is_number(text: Column) -> Column:
    return text.rlike(POINT_NUMBER) | text.rlike(NAMED_NUMBER)


def number(text: Column) -> Column:
    """Hard cast to double; text that is not a number fails the run."""
    return F.when(text.isNull() | _is_number(text), text.cast("double")).otherwise(_not_a_number(text, "double"))


def numeric_or_null(text: Column) -> Column:
    """Soft numeric cast for profiling raw text; staging uses the hard cast instead."""
    return F.when(_is_number(text), text.try_cast("double"))


def is_missing(text: Column) -> Column:
    return text.isNull() | (text == F.lit(""))
