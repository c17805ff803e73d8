"""Full refreshes that readers never see half done.

A table is written as a new version under a name of its own, may be checked there, and is published by
one catalog call that lets a view point to it. Readers use the view: before the call they get the old
rows, after it the new ones, and a query that has started keeps the version it started with, since
the one before the current is kept. A write that dies leaves the view as it was. The same holds for
plain folders, where a small file names the current version and is replaced by one rename. One writer
a table at a time is assumed; any number may read.
"""

from __future__ import annotations

import re
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSIONS = "__versions"
POINTER = "_current"


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _stamp() -> str:
    """Sorts by time of writing."""
    return f"{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"


@dataclass(frozen=True)
class Version:
    """A written table that readers of its public name do not see before it is published."""

    namespace: str
    table: str
    name: str
    columns: list[str]

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(f"{self.namespace}{VERSIONS}.{self.name}").select(*self.columns)


def bucket_count(spark: SparkSession) -> int:
    """As many buckets as shuffles start with, so that a shuffled side of a join meets the buckets as it is."""
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    first = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", shuffles)
    return min(int(first or shuffles), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))


def write_version(
    df: DataFrame,
    namespace: str,
    table: str,
    path: str | None = None,
    partition_by: str | None = None,
    bucket_by: str | None = None,
) -> Version:
    """Write ``df`` as a new version of a table; ``path`` is the folder of the namespace.

    ``partition_by`` lays rows out by a column for partition pruning; the rebalance hint lets AQE
    split a value that holds too many of them. ``bucket_by`` lays rows out for later joins, windows
    and aggregations on that column, which then need no shuffle. A bucket is read by one task, so use
    it only where no single value is large (RawTables.hot returns None).
    """
    spark = df.sparkSession
    version = Version(namespace, table, f"{table}__{_stamp()}", df.columns)
    for name, folder in ((namespace, path), (f"{namespace}{VERSIONS}", path and f"{path}/{VERSIONS}")):
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}" + (f" LOCATION {quoted(folder)}" if folder else ""))
    if partition_by:
        df = df.hint("rebalance", F.col(partition_by))
    buckets = bucket_count(spark)
    if bucket_by:
        # The same hash as the buckets, so each task writes one file.
        df = df.repartition(buckets, bucket_by)
    writer = df.write.mode("errorifexists").format("parquet")
    if path is not None:
        writer = writer.option("path", f"{path}/{table}/{version.name}")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(f"{namespace}{VERSIONS}.{version.name}")
    return version


def current_version(spark: SparkSession, namespace: str, table: str) -> str | None:
    """Name of the version that the public view points to; None where there is no such view."""
    if not spark.catalog.tableExists(f"{namespace}.{table}"):
        return None
    text = spark.sql(f"DESCRIBE TABLE EXTENDED {namespace}.{table}").filter("col_name = 'View Text'").collect()
    found = re.search(rf"{re.escape(VERSIONS)}\.(\S+)$", text[0]["data_type"]) if text else None
    return found[1] if found else None


def publish(spark: SparkSession, version: Version, description: str | None = None) -> DataFrame:
    """Let the public name mean this version; versions older than the one before it are deleted.

    A plain table of that name, as earlier releases wrote, is replaced by the view, once.
    """
    public = f"{version.namespace}.{version.table}"
    before = current_version(spark, version.namespace, version.table)
    columns = ", ".join(f"`{c}`" for c in version.columns)
    query = f"SELECT {columns} FROM {version.namespace}{VERSIONS}.{version.name}"
    if before:
        spark.sql(f"ALTER VIEW {public} AS {query}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {public}")
        spark.sql(f"CREATE VIEW {public} AS {query}")
    if description:
        describe(spark, public, description)
    _prune(spark, version.namespace, version.table, before or version.name)
    return version.read(spark)


def describe(spark: SparkSession, public: str, description: str) -> None:
    """The description of a published table."""
    spark.sql(f"ALTER VIEW {public} SET TBLPROPERTIES ('comment' = {quoted(description)})")


def describe_columns(spark: SparkSession, namespace: str, table: str, columns: dict[str, str]) -> None:
    """Column descriptions of a published table: on its current version, from which the view takes them."""
    name = current_version(spark, namespace, table)
    versioned = f"{namespace}{VERSIONS}.{name}"
    for column, text in columns.items():
        spark.sql(f"ALTER TABLE {versioned} ALTER COLUMN {column} COMMENT {quoted(text)}")
    names = ", ".join(f"`{c}`" for c in spark.table(f"{namespace}.{table}").columns)
    spark.sql(f"ALTER VIEW {namespace}.{table} AS SELECT {names} FROM {versioned}")


def withdraw(spark: SparkSession, namespace: str, table: str) -> None:
    """Remove a public name with all its versions, or a plain table."""
    if current_version(spark, namespace, table):
        spark.sql(f"DROP VIEW IF EXISTS {namespace}.{table}")
        _prune(spark, namespace, table, None)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {namespace}.{table}")


def _prune(spark: SparkSession, namespace: str, table: str, least: str | None) -> None:
    """Delete the versions written before ``least``, or all."""
    # The list also names temporary views of the session.
    rows = spark.sql(f"SHOW TABLES IN {namespace}{VERSIONS}").filter("not isTemporary").collect()
    for name in sorted(r["tableName"] for r in rows):
        if name.startswith(f"{table}__") and (least is None or name < least.lower()):
            place = spark.sql(f"DESCRIBE TABLE EXTENDED {namespace}{VERSIONS}.{name}").filter("col_name = 'Location'").collect()
            spark.sql(f"DROP TABLE IF EXISTS {namespace}{VERSIONS}.{name}")
            if place:
                _system(spark, place[0]["data_type"]).delete(_path(spark, place[0]["data_type"]), True)


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def _system(spark: SparkSession, text: str):
    return _path(spark, text).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_folder_version(df: DataFrame, folder: str, rows_per_file: int = 0) -> str:
    """Write Parquet files as a new version below a folder; returns its name."""
    name = f"v{_stamp()}"
    df.write.mode("errorifexists").option("maxRecordsPerFile", rows_per_file).parquet(f"{folder}/{name}")
    return name


def publish_folder(spark: SparkSession, folder: str, name: str) -> None:
    """Let readers of the folder find this version, by renaming a small file over the old one."""
    jvm, system = spark._jvm, _system(spark, folder)
    before = current_folder(spark, folder)
    fresh = _path(spark, f"{folder}/{POINTER}.{name}")
    out = system.create(fresh, True)
    out.write(bytearray(name.encode()))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    over = spark.sparkContext._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(system.makeQualified(fresh), system.makeQualified(_path(spark, f"{folder}/{POINTER}")), over)
    least = before or name
    for status in system.listStatus(_path(spark, folder)):
        old = status.getPath().getName()
        if old.startswith("v") and old < least:
            system.delete(status.getPath(), True)


def current_folder(spark: SparkSession, folder: str) -> str | None:
    """Name of the version that readers of the folder find; None where nothing was published."""
    system, pointer = _system(spark, folder), _path(spark, f"{folder}/{POINTER}")
    if not system.exists(pointer):
        return None
    stream = system.open(pointer)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
