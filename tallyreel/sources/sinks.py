"""Marts on disk: tables in two namespaces, with their documentation in the catalog."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyreel.sources.publish import describe, describe_columns, publish, write_version

# Facts any team may adopt, and definitions one team owns.
STAGING_NAMESPACE = "staging"
DATA_NAMESPACE = "marts_data"
PRODUCT_NAMESPACE = "marts_product"


def staging_view(df: DataFrame, name: str) -> DataFrame:
    """Cleaning stays lazy: a temporary view, nothing written."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def write_mart(
    df: DataFrame,
    namespace: str,
    table: str,
    path: str | None = None,
    partition_by: str | None = None,
    bucket_by: str | None = None,
    check: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Full refresh of one mart table, published in one step; returned as a scan of what was written.

    ``check`` sees the written rows first; if it raises, readers keep the old ones. For the layout see
    ``write_version``.
    """
    version = write_version(df, namespace, table, path, partition_by, bucket_by)
    if check:
        check(version.read(df.sparkSession))
    return publish(df.sparkSession, version)


def with_comments(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Attach column descriptions to the schema, so that the write itself stores them."""
    return df.select(
        *[F.col(c).alias(c, metadata={"comment": columns[c]}) if c in columns else c for c in df.columns]
    )


def persist_docs(spark: SparkSession, table: str, description: str, columns: Mapping[str, str]) -> None:
    """Write table and column descriptions of a published table into the catalog."""
    describe(spark, table, description)
    if columns:
        describe_columns(spark, *table.rsplit(".", 1), dict(columns))


def documented_columns(spark: SparkSession, table: str) -> DataFrame:
    """Column names and comments as the catalog holds them."""
    return spark.sql(f"DESCRIBE TABLE {table}").select("col_name", "comment")
