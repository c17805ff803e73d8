"""The four raw extracts, derived from the driver's order tables.

The mapping is integer arithmetic and date addition only, and plants the defects the engine has to
handle: copied events, timestamp encodings, orphans, impossible runtimes, odd spellings and numbers.
Every line, order and part feeds a row; sessions and lifecycles differ in length by which rows are
assigned to them. Every output column is text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyreel.config import standard_config
from tallyreel.sources.raw import RAW_COLUMNS, LandedOnDemand, RawTables, standard_rates
from tallyreel.sources.workspace import shared_folder

# Fixed values of the mapping.
STATES = ["FL", "tx", "Georgia", "Ga.", "Texas", "Florida", "GA"]
SPORTS = ["Hockey", "HOCKEY", "football", "FB", "BBALL", "VB", "Soccer", "TRACK"]
DEVICES = ["ios", "android", "web", "roku", "firetv", "appletv"]
FIRST_EPOCH = 1756684800


def _pick(index: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _numbers(*values: int) -> Column:
    return F.array(*[F.lit(v).cast("bigint") for v in values])


def _day(first: str, offset: Column) -> Column:
    return F.date_add(F.lit(first).cast("date"), offset.cast("int")).cast("string")


def _text(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in RAW_COLUMNS[table]])


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    df = _table(spark, sf_dir, "customer").select(
        k.alias("user_id"),
        F.concat(_day("2025-01-01", k % 240), F.lit("T08:00:00Z")).alias("signup_ts"),
        _pick(k % 7, STATES).alias("home_state"),
        F.lower("c_mktsegment").alias("acquisition_channel"),
    )
    return _text(df, "users")


def raw_asset_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    slot = k % 40
    copies = F.when(k % 29 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    name = F.concat_ws(" ", "p_name", k.cast("string"))
    df = (
        _table(spark, sf_dir, "part")
        .withColumn("replay", F.explode(copies))
        .select(
            k.alias("asset_id"),
            F.when(F.col("replay"), F.concat(name, F.lit(" (Replay)"))).otherwise(name).alias("title"),
            F.when(~F.col("replay") & (k % 3 == 0), "LIVE").otherwise("VOD").alias("asset_type"),
            _pick(k % 8, SPORTS).alias("sport"),
            F.col("p_brand").alias("home_school"),
            F.col("p_type").alias("away_school"),
            F.concat(_day("2025-09-01", k % 150), F.lit("T19:00:00Z")).alias("scheduled_start_ts"),
            F.when(slot == 3, -600).when(slot == 4, -1).when(slot == 5, 0).otherwise(600 + slot * 90)
            .alias("duration_seconds"),
        )
    )
    return _text(df, "asset_catalog")


def raw_playback_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = _table(spark, sf_dir, "customer").agg(F.count(F.lit(1))).scalar()
    parts = _table(spark, sf_dir, "part").agg(F.count(F.lit(1))).scalar()
    s, rn, last, e, t = (F.col(c) for c in ("s", "rn", "last_rn", "e", "t"))
    line_order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    # One window serves both columns: same order, other frame.
    in_session = Window.partitionBy("s").orderBy(*line_order)
    whole = in_session.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    base = (
        _table(spark, sf_dir, "lineitem")
        .withColumn("block", F.expr("l_orderkey div 10"))
        # Each ten orders make two sessions, two to eight orders long.
        .withColumn("s", F.col("block") * 2 + (F.col("l_orderkey") % 10 > 1 + F.col("block") % 7).cast("int"))
        .select("s", *line_order)
        .withColumns({"rn": F.row_number().over(in_session), "last_rn": F.count(F.lit(1)).over(whole)})
        .withColumn("rn", rn.cast("bigint"))
        .select(
            "s",
            "rn",
            "last_rn",
            (s * 1000 + rn).alias("e"),
            (F.lit(FIRST_EPOCH) + (s % 180) * 86400 + (s % 24) * 3600 + rn * 60).alias("t"),
        )
    )
    kind = (
        F.when(rn == 1, "play").when(rn == last, "stop").when(rn % 11 == 0, "pause")
        .when(rn % 13 == 0, "buffer").otherwise("heartbeat")
    )
    stamp = F.timestamp_add("SECOND", t, F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))).cast("string")
    user = (
        F.when(s % 6 == 0, F.lit(None)).when(s % 41 == 0, 900000 + s)
        .otherwise((s * 7) % F.floor(users * 2 / 3))
    )
    spaced = F.replace(stamp, F.lit(" "), F.lit("T"))
    event = base.select(
        "e",
        F.concat(F.lit("s"), s.cast("string")).alias("session_id"),
        user.alias("user_id"),
        F.when(s % 23 == 5, 800000 + s).otherwise((s * 11) % F.floor(parts / 2)).alias("asset_id"),
        kind.alias("event_type"),
        F.when(e % 5 == 0, t.cast("string")).when(e % 25 == 1, F.replace(stamp, F.lit("-"), F.lit("/")))
        .when(e % 5 == 1, stamp)
        .otherwise(F.concat(spaced, F.lit("Z"))).alias("event_ts"),
        (rn * 60 + F.when(rn == last, 237).otherwise(0)).alias("position_seconds"),
        _pick(s % 6, DEVICES).alias("device_type"),
        F.concat(F.lit("5."), (s % 4).cast("string")).alias("app_version"),
        F.concat((800 + (s % 53) * 100).cast("string"), F.when(s % 53 == 11, ".5").when(s % 53 == 12, ".0").otherwise(""))
        .alias("bitrate_kbps"),
    )
    copied, late = e % 97 == 0, (e % 89 == 0) & (F.col("event_type") == "heartbeat")
    # Spelled out: dropping NULLs from an array runs as a function of its own, once a row.
    extra = (
        F.when(copied & late, _numbers(0, 0, 500)).when(copied, _numbers(0, 0)).when(late, _numbers(0, 500)).otherwise(_numbers(0))
    )
    df = event.withColumn("shift", F.explode(extra)).withColumn("event_id", e + F.col("shift"))
    return _text(df, "playback_events")


def raw_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = _table(spark, sf_dir, "customer").agg(F.count(F.lit(1))).scalar()
    sid, step, plan = F.col("sid"), F.col("step"), F.col("plan_type")
    day = _day("2025-03-01", (sid * 11) % 307 + step * (20 + sid % 60))
    df = (
        _table(spark, sf_dir, "orders")
        # Each six orders make six, three or two subscriptions, so with one, two or three changes.
        .withColumns({"block": F.expr("o_orderkey div 6"), "at": F.col("o_orderkey") % 6})
        .withColumn("changes", F.col("block") % 3 + 1)
        .select(F.expr("block * 6 + at div changes").alias("sid"), (F.col("at") % F.col("changes")).alias("step"), "changes")
        .withColumn(
            "plan_type",
            F.when((F.col("changes") < 3) & (sid % 5 == 0), "free_trial").when(sid % 4 == 1, "annual").otherwise("monthly"),
        )
        .select(
            sid.alias("subscription_id"),
            F.when(sid % 37 == 0, 900000 + sid).otherwise((sid * 7) % F.floor(users * 4 / 5)).alias("user_id"),
            "plan_type",
            F.when(plan == "free_trial", F.when(step == 0, "trialing").otherwise("expired"))
            .otherwise(F.when(step == 1, "canceled").otherwise("active")).alias("status"),
            F.when((sid + step) % 7 == 0, F.concat(day, F.lit(" 10:00:00")))
            .otherwise(F.concat(day, F.lit("T10:00:00Z"))).alias("event_effective_ts"),
            F.when(plan == "annual", "79.99").when(plan == "monthly", "9.99").otherwise("0.00")
            .alias("mrr_amount"),
            F.when(sid % 50 == 1, "GBP").when(sid % 50 == 2, "EUR").otherwise("USD").alias("currency"),
        )
    )
    return _text(df, "subscriptions")


def mapped_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "playback_events": raw_playback_events(spark, sf_dir),
        "subscriptions": raw_subscriptions(spark, sf_dir),
        "asset_catalog": raw_asset_catalog(spark, sf_dir),
        "users": raw_users(spark, sf_dir),
    }


# Driver table behind each raw table.
ORIGINS = {
    "playback_events": "lineitem",
    "subscriptions": "orders",
    "asset_catalog": "part",
    "users": "customer",
}
_LANDED: dict[tuple[str, str], RawTables] = {}


def landed_sample(spark: SparkSession, sf_dir: str) -> RawTables:
    """The mapped tables as the raw layer, each landed once per Spark application and folder, by the first query that reads it."""
    where = (spark.sparkContext.applicationId, sf_dir)
    if where not in _LANDED:
        folder = f"{shared_folder(spark)}/raw-{len(_LANDED)}"
        origins = {name: _table(spark, sf_dir, origin) for name, origin in ORIGINS.items()}
        tables = LandedOnDemand(mapped_tables(spark, sf_dir), origins, folder, spark.sparkContext.defaultParallelism)
        _LANDED[where] = RawTables(tables, standard_rates(spark), standard_config().max_group_rows)
    return _LANDED[where]
