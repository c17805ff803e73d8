"""Landing: text in, text stored. Casting is staging's job, where it can be checked."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyreel.operators.rates import has_many_periods
from tallyreel.operators.split_window import HotGroups, find_hot_keys
from tallyreel.sources.publish import current_folder, publish, publish_folder, withdraw, write_folder_version, write_version
from tallyreel.sources.quoted_lines import read_records

# The four extracts and their columns.
RAW_COLUMNS = {
    "playback_events": [
        "event_id",
        "session_id",
        "user_id",
        "asset_id",
        "event_type",
        "event_ts",
        "position_seconds",
        "device_type",
        "app_version",
        "bitrate_kbps",
    ],
    "subscriptions": [
        "subscription_id",
        "user_id",
        "plan_type",
        "status",
        "event_effective_ts",
        "mrr_amount",
        "currency",
    ],
    "asset_catalog": [
        "asset_id",
        "title",
        "asset_type",
        "sport",
        "home_school",
        "away_school",
        "scheduled_start_ts",
        "duration_seconds",
    ],
    "users": ["user_id", "signup_ts", "home_state", "acquisition_channel"],
}

# Columns, and the types they are read as, by which windows and sessions group these tables.
GROUP_KEYS = {
    "playback_events": [("session_id", "string")],
    "subscriptions": [("subscription_id", "string"), ("subscription_id", "bigint"), ("user_id", "string"), ("user_id", "bigint")],
}

RATE_SCHEMA = T.StructType(
    [
        T.StructField("currency", T.StringType()),
        T.StructField("rate_to_usd", T.DoubleType()),
        T.StructField("valid_from", T.DateType()),
        T.StructField("valid_to", T.DateType()),
        T.StructField("source_note", T.StringType()),
    ]
)


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


# A quote inside a quoted value is doubled, and a backslash is an ordinary sign.
CSV_OPTIONS = {"header": "true", "escape": '"'}


def read_raw_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Header CSV with every column as text, without inference.

    Values may hold line breaks inside quotes, and files split all the same. One scan looks for
    them; where there are none, the plain line reader does the rest.
    """
    schema = text_schema(columns)
    found = read_records(spark, path)
    if found is None:
        reader = spark.read.schema(schema).options(**CSV_OPTIONS).option("enforceSchema", False)
        return reader.option("mode", "FAILFAST").csv(path)
    parsed = found.withColumn("row", F.from_csv("record", schema.simpleString(), {"escape": '"', "mode": "FAILFAST"}))
    as_declared = reduce(lambda x, y: x & y, [F.col("row")[c].eqNullSafe(F.lit(c)) for c in columns])
    wrong = F.raise_error(F.concat(F.lit("CSV header does not conform to the schema: "), F.col("record"))).cast("boolean")
    rows = parsed.filter(F.when(~F.col("header"), True).when(as_declared, False).otherwise(wrong))
    return rows.select(*[F.col("row")[c].alias(c) for c in columns])


def write_raw_csv(df: DataFrame, path: str) -> None:
    """What ``read_raw_csv`` reads; blanks at the ends of values stay."""
    keep = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.mode("overwrite").options(**CSV_OPTIONS, **keep).csv(path)


def read_extracts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The four CSV extracts of one folder; a missing file fails when Spark resolves its path."""
    return {t: read_raw_csv(spark, f"{folder}/{t}.csv", cols) for t, cols in RAW_COLUMNS.items()}


def load_seed(spark: SparkSession, path: str, schema: T.StructType = RATE_SCHEMA) -> DataFrame:
    """Typed small lookup from CSV; a value of the wrong type or a wrong header fails. A file is read whole, by one task."""
    reader = spark.read.schema(schema).options(**CSV_OPTIONS, multiLine="true").option("enforceSchema", False)
    return reader.option("mode", "FAILFAST").csv(path)


def standard_rates(spark: SparkSession) -> DataFrame:
    """The standing rate table. As a local relation its size is known to the planner."""
    # Currency, rate to USD, first and last day, note.
    return spark.sql(
        """
        SELECT currency, CAST(rate_to_usd AS DOUBLE) AS rate_to_usd,
               CAST(valid_from AS DATE) AS valid_from, CAST(valid_to AS DATE) AS valid_to, source_note
        FROM VALUES
          ('USD', 1.00, '1900-01-01', '2999-12-31', 'identity'),
          ('GBP', 1.27, '1900-01-01', '2999-12-31', 'placeholder - awaiting finance-maintained rates'),
          ('EUR', 1.09, '1900-01-01', '2999-12-31', 'placeholder - awaiting finance-maintained rates')
          AS t(currency, rate_to_usd, valid_from, valid_to, source_note)
        """
    )


@dataclass
class RawTables:
    """Landed raw tables, the rate table, and which of their groups are too big for one task."""

    tables: Mapping[str, DataFrame]
    rates: DataFrame
    max_group_rows: int
    _hot: dict[tuple[str, str, str], HotGroups | None] = field(default_factory=dict)

    def __getitem__(self, table: str) -> DataFrame:
        return self.tables[table]

    def hot(self, table: str, key: str, key_type: str = "string") -> HotGroups | None:
        """Groups above the row limit, found on the landed rows, for all keys of the table at once.

        Cleaning only drops rows of a group, so this also covers every table derived from it.
        """
        if (table, key, key_type) not in self._hot:
            wanted = {*GROUP_KEYS.get(table, ()), (key, key_type)}
            found = find_hot_keys(self.tables[table], {f"{k} {t}": (k, t) for k, t in wanted}, self.max_group_rows)
            self._hot |= {(table, *name.split(" ")): groups for name, groups in found.items()}
        return self._hot[table, key, key_type]

    @cached_property
    def many_rate_periods(self) -> bool:
        return has_many_periods(self.rates, "currency")


def land_raw(
    tables: Mapping[str, DataFrame], folder: str, rows_per_file: Mapping[str, int] | None = None
) -> dict[str, DataFrame]:
    """Full refresh of the raw layer as Parquet files below one folder; tables no longer delivered go.

    All tables are written before the first one is switched to its new version, each in one step. A row
    limit per file keeps even a small table readable by several tasks, without a shuffle.
    """
    written = {n: write_folder_version(df, f"{folder}/{n}", (rows_per_file or {}).get(n, 0)) for n, df in tables.items()}
    landed = {}
    for name, version in written.items():
        spark = tables[name].sparkSession
        publish_folder(spark, f"{folder}/{name}", version)
        landed[name] = spark.read.schema(tables[name].schema).parquet(f"{folder}/{name}/{version}")
    if landed:
        _drop_undelivered(spark, folder, set(RAW_COLUMNS) - set(landed))
    return landed


class LandedOnDemand(Mapping[str, DataFrame]):
    """Raw tables below a fresh folder, each landed when it is first asked for: a query lands only what it reads.

    ``files`` cut a table, by the rows of the table it stems from.
    """

    def __init__(self, tables: Mapping[str, DataFrame], origins: Mapping[str, DataFrame], folder: str, files: int) -> None:
        self._tables, self._origins, self._folder, self._files = tables, origins, folder, files
        self._landed: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._landed:
            df, below = self._tables[name], f"{self._folder}/{name}"
            # Row counts come from the Parquet footers; about one file per core for a small table.
            version = write_folder_version(df, below, max(1_000, self._origins[name].count() // self._files))
            publish_folder(df.sparkSession, below, version)
            self._landed[name] = df.sparkSession.read.schema(df.schema).parquet(f"{below}/{version}")
        return self._landed[name]

    def __contains__(self, name: object) -> bool:
        return name in self._tables

    def __iter__(self) -> Iterator[str]:
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)


def landed_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The extracts that a landed folder holds now, in their current version."""
    current = {name: current_folder(spark, f"{folder}/{name}") for name in RAW_COLUMNS}
    return {
        name: spark.read.schema(text_schema(RAW_COLUMNS[name])).parquet(f"{folder}/{name}/{version}")
        for name, version in current.items()
        if version
    }


def _drop_undelivered(spark: SparkSession, folder: str, names: set[str]) -> None:
    """Removes the extracts of these names from the raw layer; other folders are not touched."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name in names:
        system.delete(path(f"{folder}/{name}"), True)


def land_raw_tables(tables: Mapping[str, DataFrame], namespace: str = "raw") -> None:
    """Full refresh of the raw layer as catalog tables; tables no longer delivered are dropped.

    Reading resolves every extract first, and all are written before the first one is published, so a
    missing or broken one fails before anything is replaced.
    """
    spark = next(iter(tables.values())).sparkSession
    for version in [write_version(df, namespace, name) for name, df in tables.items()]:
        publish(spark, version)
    for row in spark.sql(f"SHOW TABLES IN {namespace}").collect():
        if row["tableName"] not in tables and not row["isTemporary"]:
            withdraw(spark, namespace, row["tableName"])


def landing_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row and column count per landed table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
