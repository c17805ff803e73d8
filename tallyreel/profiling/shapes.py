"""Text shapes: encodings, blanks, categories, codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyreel.functions.cleaning import is_missing, numeric_or_null
from tallyreel.functions.numeric import percent
from tallyreel.functions.timestamps import is_epoch_text, is_iso_utc_text, normalize_timestamp
from tallyreel.operators.classify import bucketize_labels
from tallyreel.profiling.shared import one_row_to_many, row_count, stacked, with_share


def string_shapes(df: DataFrame, column: str) -> DataFrame:
    """Seven-way shape census of a timestamp text column."""
    text = F.col(column)
    # Shape labels.
    shape = bucketize_labels(
        [
            (text.isNull(), "1. NULL"),
            (text == "", "2. empty string"),
            (is_epoch_text(text), "3. epoch digits"),
            (text.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}T.*Z\z"), "4. ISO-8601 Z"),
            (text.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}T"), "5. ISO no Z"),
            (text.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2} "), "6. ISO space sep"),
        ],
        "7. OTHER",
    )
    return _census(df, shape, column, "ts_shape", ("min_example", "max_example")).orderBy("ts_shape")


def _census(df: DataFrame, shape: Column, column: str, name: str, examples: tuple[str, str]) -> DataFrame:
    counted = df.groupBy(shape.alias(name)).agg(
        row_count().alias("rows"), F.min(column).alias(examples[0]), F.max(column).alias(examples[1])
    )
    return with_share(counted, "rows", 2).select(name, "rows", "pct", *examples)


def encoding_share(df: DataFrame, column: str) -> DataFrame:
    text = F.col(column)
    # Shape labels.
    shape = bucketize_labels(
        [(is_epoch_text(text), "epoch seconds"), (is_iso_utc_text(text), "ISO-8601 Z")],
        "ISO space-separated (no tz)",
    )
    census = _census(df, shape, column, "shape", ("example_min", "example_max"))
    return census.orderBy(F.desc("rows"), "shape")


def two_way_encoding(df: DataFrame, column: str) -> DataFrame:
    # Shape labels.
    shape = bucketize_labels([(is_iso_utc_text(F.col(column)), "ISO-8601 Z")], "ISO space-separated (no tz)")
    return df.groupBy(shape.alias("shape")).agg(row_count().alias("rows"))


def _encoding_counts(text: Column) -> list[Column]:
    return [
        F.count_if(is_epoch_text(text)).alias("epoch"),
        F.count_if(is_iso_utc_text(text)).alias("iso_z"),
        F.count_if(text.like("% %")).alias("iso_space"),
    ]


def encoding_by(df: DataFrame, dimension: str, column: str) -> DataFrame:
    return df.groupBy(dimension).agg(*_encoding_counts(F.col(column))).orderBy(dimension)


def encoding_period(df: DataFrame, column: str) -> DataFrame:
    """First and last instant per encoding: do the encodings cover the same time?"""
    text = F.col(column)
    # Shape labels.
    shape = bucketize_labels([(is_epoch_text(text), "epoch"), (is_iso_utc_text(text), "iso_z")], "iso_space")
    at = normalize_timestamp(text)
    return (
        df.groupBy(shape.alias("shape"))
        .agg(row_count().alias("rows"), F.min(at).alias("min_ts"), F.max(at).alias("max_ts"))
        .orderBy("shape")
    )


def ts_formats(columns: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    return stacked(
        [
            df.agg(*_encoding_counts(F.col(c)), F.count_if(is_missing(F.col(c))).alias("missing")).select(
                F.lit(label).alias("col"), "epoch", "iso_z", "iso_space", "missing"
            )
            for label, df, c in columns
        ]
    )


def nulls_and_blanks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL and blank counts per column, all from one scan and over the real row count."""
    aggregates = [row_count().alias("_total")]
    rows = []
    for c in columns:
        aggregates.append(F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"))
        aggregates.append(F.count_if(F.col(c) == "").alias(f"{c}_blanks"))
        nulls, blanks = F.col(f"{c}_nulls"), F.col(f"{c}_blanks")
        rows.append(
            {
                "col": F.lit(c),
                "nulls": nulls,
                "blanks": blanks,
                "pct_missing": percent(nulls + blanks, F.col("_total"), 2),
            }
        )
    return one_row_to_many(df.agg(*aggregates), rows).orderBy(F.desc("pct_missing"), "col")


def categorical(tables: Sequence[tuple[str, DataFrame, Sequence[str]]], limit: int = 40) -> DataFrame:
    """Most frequent values per column; one scan per table.

    The rank over counted values is cut before the shuffle (a group limit per map task), so a
    column with countless values sends at most ``limit`` rows from each.
    """
    parts = []
    for name, df, columns in tables:
        cells = [F.struct(F.lit(f"{name}.{c}").alias("col"), F.col(c).alias("value")) for c in columns]
        parts.append(df.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*"))
    counted = stacked(parts).groupBy("col", "value").agg(row_count().alias("rows"))
    rank = F.row_number().over(
        Window.partitionBy("col").orderBy(F.desc("rows"), F.col("value").asc_nulls_last())
    )
    return counted.withColumn("_rank", rank).filter(F.col("_rank") <= limit).drop("_rank")


def code_oddities(df: DataFrame, column: str, length: int = 2) -> DataFrame:
    code = F.col(column)
    return df.agg(
        F.count_distinct(column).alias("distinct_states"),
        F.count_if(F.length(code) != length).alias("not_two_chars"),
        F.count_if(code != F.upper(code)).alias("not_upper"),
        F.count_if(is_missing(code)).alias("missing"),
    )


def bad_codes(df: DataFrame, column: str, count: str, length: int = 2) -> DataFrame:
    code = F.col(column)
    return (
        df.filter((F.length(code) != length) | (code != F.upper(code)))
        .groupBy(column)
        .agg(row_count().alias(count))
        .orderBy(F.desc(count), column)
    )


def whitespace(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Untrimmed values per column; one scan per table."""
    parts = []
    for name, (df, columns) in tables.items():
        counts = [F.count_if(F.col(c) != F.trim(c)).alias(c) for c in columns]
        rows = [{"col": F.lit(f"{name}.{c}"), "untrimmed": F.col(c)} for c in columns]
        parts.append(one_row_to_many(df.agg(*counts), rows))
    return stacked(parts)


def spelling_variants(df: DataFrame, column: str, count: str) -> DataFrame:
    return df.groupBy(column).agg(row_count().alias(count)).orderBy(F.lower(column), column)


def bad_durations(catalog: DataFrame, columns: Sequence[str], nulls_too: bool) -> DataFrame:
    runtime = numeric_or_null(F.col("duration_seconds"))
    bad = runtime <= 0
    if nulls_too:
        bad = bad | F.col("duration_seconds").isNull()
    return catalog.filter(bad).orderBy(runtime.asc_nulls_last(), "asset_id").select(*columns)
