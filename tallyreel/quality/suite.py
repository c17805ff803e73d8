"""Run declared checks and report how many rows fail each."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyreel.profiling.shared import one_row_to_many, row_count, stacked
from tallyreel.quality import checks as Q
from tallyreel.quality.declared import Declared


def failing_count(name: str, failing: DataFrame) -> DataFrame:
    return failing.agg(row_count().alias("failing_rows")).select(F.lit(name).alias("check_name"), "failing_rows")


def table_checks(df: DataFrame, declared: Declared) -> DataFrame:
    """Row conditions and uniqueness of one table in one scan and one aggregation, whatever their number.

    A row sends a tag for each condition that it violates, and one with a 64-bit digest for each unique key;
    tags are counted together, combined before the shuffle. A digest that occurs once proves its key unique.
    The few that occur more often are looked at in a second scan, by the values themselves; it is
    not run where there are none.
    """
    prefix = declared.table
    conditions = {
        **{f"{prefix}.{c}: not_null": Q.null_value(c) for c in declared.not_null},
        **{f"{prefix}.{c}: accepted_values": Q.unexpected_value(c, v) for c, v in declared.accepted.items()},
        **{f"{prefix}: expression {i}": Q.violates(e) for i, e in enumerate(declared.expressions, 1)},
    }
    keys = {
        **{f"{prefix}.{c}: unique": [c] for c in declared.unique},
        **{f"{prefix}.({', '.join(c)}): unique_combination": c for c in declared.unique_together},
    }
    names = [*conditions, *keys]

    def tag(name: str, *values: Column) -> Column:
        return F.struct(F.lit(names.index(name)).alias("check"), *values)

    def compared(name: str) -> Column:
        # A NULL in a single key is another check's question; in a combination it is a value.
        return F.col(keys[name][0]).isNotNull() if name.endswith(": unique") else F.lit(True)

    def exploded(tags: list[Column]) -> DataFrame:
        return df.select(F.explode(F.array_compact(F.array(*tags))).alias("t")).select("t.*")

    digests = {name: F.xxhash64(*columns) for name, columns in keys.items()}
    tags = [F.when(violated, tag(name, F.lit(0).cast("bigint").alias("digest"))) for name, violated in conditions.items()]
    tags += [F.when(compared(name), tag(name, digest.alias("digest"))) for name, digest in digests.items()]
    counted = exploded(tags).groupBy("check", "digest").agg(row_count().alias("n"))

    def totals(rows: DataFrame, of: dict, value: str) -> DataFrame:
        sums = [F.coalesce(F.sum(F.when(F.col("check") == names.index(name), F.col(value))), F.lit(0)).alias(f"c{names.index(name)}") for name in of]
        return one_row_to_many(rows.agg(*sums), [{"check_name": F.lit(n), "failing_rows": F.col(f"c{names.index(n)}")} for n in of])

    parts = [totals(counted, conditions, "n")] if conditions else []
    if keys:
        # The condition needs the count, so that it stays above the aggregation, which both branches then share.
        least = F.when(F.col("check") >= len(conditions), 1)
        seen = counted.filter(F.col("n") > least).select("check", "digest")
        spelled = [
            F.when(compared(name), tag(name, digests[name].alias("digest"), F.array(*[F.col(c).cast("string") for c in columns]).alias("key")))
            for name, columns in keys.items()
        ]
        again = exploded(spelled).join(seen, ["check", "digest"], "left_semi")
        repeated = again.groupBy("check", "key").agg(row_count().alias("n")).filter("n > 1")
        parts.append(totals(repeated.groupBy("check").agg(row_count().alias("failing_rows")), keys, "failing_rows"))
    return stacked(parts)


def run_declared(tables: Callable[[str], DataFrame], suite: Sequence[Declared]) -> DataFrame:
    """(check_name, failing_rows) for every declared check; zero is a pass."""
    parts = []
    for declared in suite:
        df = tables(declared.table)
        parts.append(table_checks(df, declared))
        for column, parent, parent_column in declared.relationships:
            failing = Q.check_relationships(df, column, tables(parent), parent_column)
            parts.append(failing_count(f"{declared.table}.{column}: relationships {parent}", failing))
    return stacked(parts)
