"""Timestamp normalization: three text encodings to one naive UTC timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ALL_DIGITS = r"\A[0-9]+\z"  # \A..\z, because $ would accept a trailing newline
# A naive cast would read '2025-09' as the first of the month and '2025-09-01 10' as ten o'clock.
# Only a full date, alone or with at least hours and minutes, counts as a timestamp.
FULL_SHAPE = r"\A\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(\s*|[ T]+[0-9]{1,2}:[0-9]{1,2}.*)\z"
# Dates may be written with slashes; behind the date they would belong to a zone name.
SLASH_DATE = r"\A(\s*[0-9]{4})/([0-9]{1,2})/"
# Largest second count a microsecond timestamp can hold; more is NULL instead of an aborted job.
# Thirteen-digit milliseconds stay inside it on purpose, so that the range check can flag them.
MAX_EPOCH_SECONDS = 9_223_372_036_853

# Names of the three encodings.
EPOCH_SECONDS = "epoch_seconds"
ISO_UTC = "iso8601_utc"
ISO_ASSUMED_UTC = "iso8601_no_timezone_assumed_utc"


def is_epoch_text(text: Column) -> Column:
    return text.rlike(ALL_DIGITS)


def is_iso_utc_text(text: Column) -> Column:
    """Same as LIKE '%T%Z', which would run as a backtracking regular expression."""
    return text.endswith("Z") & text.contains("T")


def parse_naive(text: Column) -> Column:
    """Soft cast of date-time text to a naive timestamp; anything incomplete is NULL."""
    dashed = F.when(text.contains("/"), F.regexp_replace(text, SLASH_DATE, "$1-$2-")).otherwise(text)
    return F.when(dashed.rlike(FULL_SHAPE), dashed.try_cast("timestamp_ntz"))


def normalize_timestamp(text: Column) -> Column:
    seconds = text.try_cast("bigint")
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    from_epoch = F.when(seconds <= F.lit(MAX_EPOCH_SECONDS), F.timestamp_add("SECOND", seconds, epoch))
    stripped = F.replace(F.replace(text, F.lit("T"), F.lit(" ")), F.lit("Z"), F.lit(""))
    return (
        F.when(is_epoch_text(text), from_epoch)
        .when(is_iso_utc_text(text), parse_naive(stripped))
        .otherwise(parse_naive(text))
    )


def timestamp_source_format(text: Column) -> Column:
    """Tag of the encoding. NULL text takes the last tag, like any text of no known shape."""
    return (
        F.when(is_epoch_text(text), F.lit(EPOCH_SECONDS))
        .when(is_iso_utc_text(text), F.lit(ISO_UTC))
        .otherwise(F.lit(ISO_ASSUMED_UTC))
    )


def _seconds_since_year_one(ts: Column) -> Column:
    return F.timestamp_diff("SECOND", F.to_timestamp_ntz(F.lit("0001-01-01 00:00:00")), ts)


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from start to end: 0.9 s -> 1.1 s counts one."""
    return _seconds_since_year_one(end) - _seconds_since_year_one(start)


def days_between(start: Column, end: Column) -> Column:
    """Day boundaries crossed: 23:59:59 -> 00:00:01 counts one."""
    return F.datediff(end.cast("date"), start.cast("date")).cast("bigint")
