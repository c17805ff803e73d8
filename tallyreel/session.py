"""SparkSession settings the engine relies on."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# UTC keeps casts between zoned and naive timestamps neutral; ANSI makes a bad hard cast fail
# the run; AQE re-plans joins by measured size (broadcast or sort-merge) and splits skewed joins.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Only settable before the session starts: Python call sites in error messages cost a round trip
# to the JVM per expression.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

TASK_BYTES = 128 * 1024 * 1024


def shuffle_partitions_for(shuffled_bytes: int, cores: int) -> int:
    """Partitions so that one holds about 128 MB, and at least one per core.

    100 TB through one shuffle asks for some 800,000; AQE then coalesces what turns out smaller.
    """
    return max(cores, -(-shuffled_bytes // TASK_BYTES))


def size_shuffles(spark: SparkSession, tables: Iterable[DataFrame]) -> int:
    """Sets how many partitions shuffles start with, from the planner's size of these tables; never fewer than now."""
    total = sum(int(str(t._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for t in tables)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    width = max(least, shuffle_partitions_for(total, spark.sparkContext.defaultParallelism))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(width))
    return width


def get_session(app_name: str = "tallyreel", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **START_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
