"""Numbers, times and CSV text as extracts really deliver them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyreel.functions import cleaning as C
from tallyreel.functions.numeric import round_half_away
from tallyreel.functions.timestamps import normalize_timestamp
from tallyreel.sources import raw as R
from tallyreel.sources import sample_feed

SF = "/root/testdata/sf0.001"


def one(spark, text, expr):
    return spark.createDataFrame([(text,)], "t string").select(expr(F.col("t")).alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("text", "value"),
    [("123.0", 123), ("1e3", 1000), ("800.5", 801), ("-800.5", -801), (" 7 ", 7), ("9007199254740993", 9007199254740993),
     ("9007199254740993.0", 9007199254740993), (None, None)],
)
def test_whole_numbers(spark, text, value):
    assert one(spark, text, C.whole_number) == value


@pytest.mark.parametrize("text", ["1d", "2.5f", "0x1p3", "abc", "", "1 2"])
def test_what_is_no_number(spark, text):
    assert one(spark, text, C.numeric_or_null) is None
    for cast in (C.whole_number, C.number):
        with pytest.raises(Exception, match="not a number"):
            one(spark, text, cast)


def test_numbers(spark):
    assert one(spark, "-1.5e2", C.number) == -150.0
    assert one(spark, "inf", C.number) == float("inf")
    assert one(spark, ".5", C.numeric_or_null) == 0.5


@pytest.mark.parametrize(
    ("text", "value"),
    [("2025/09/01 10:00:00", dt.datetime(2025, 9, 1, 10)), ("2025/9/1", dt.datetime(2025, 9, 1)), ("2025/09", None), ("09/01/2025", None)],
)
def test_slash_dates(spark, text, value):
    assert one(spark, text, normalize_timestamp) == value


@pytest.mark.parametrize("value", [1e17, 1e300, -1e17, float("inf")])
def test_rounding_keeps_large_numbers(spark, value):
    assert spark.range(1).select(round_half_away(F.lit(value), 2).alias("v")).first()["v"] == value


def test_csv_quotes_commas_and_backslashes(spark, tmp_path):
    (tmp_path / "users.csv").write_text(
        'user_id,signup_ts,home_state,acquisition_channel\n1,"The ""Big"" Game",GA,x\n'
        '2,"He said ""Go, team"" now",FL,y\n3,"C:\\",TX,z\n'
    )
    df = R.read_raw_csv(spark, str(tmp_path / "users.csv"), R.RAW_COLUMNS["users"])
    assert [r["signup_ts"] for r in df.orderBy("user_id").collect()] == ['The "Big" Game', 'He said "Go, team" now', "C:\\"]
    R.write_raw_csv(df, str(tmp_path / "again.csv"))
    assert sorted(R.read_raw_csv(spark, str(tmp_path / "again.csv"), R.RAW_COLUMNS["users"]).collect()) == sorted(df.collect())


def test_seed_fails_on_wrong_types(spark, tmp_path):
    (tmp_path / "r.csv").write_text("currency,rate_to_usd,valid_from,valid_to,source_note\nUSD,abc,2025-13-01,2999-12-31,x\n")
    with pytest.raises(Exception, match="MALFORMED"):
        R.load_seed(spark, str(tmp_path / "r.csv")).collect()


def test_landing_drops_what_is_no_longer_delivered(spark, tmp_path):
    tables = sample_feed.mapped_tables(spark, SF)
    R.land_raw({"users": tables["users"], "asset_catalog": tables["asset_catalog"]}, str(tmp_path))
    R.land_raw({"users": tables["users"]}, str(tmp_path))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["users"]


def test_the_feed_uses_every_driver_row(spark):
    """Row counts equal the driver tables plus the planted copies."""
    tables = sample_feed.mapped_tables(spark, SF)
    count = {n: spark.read.parquet(f"{SF}/{n}.parquet").count() for n in ("lineitem", "orders", "part", "customer")}
    events, catalog = tables["playback_events"], tables["asset_catalog"]
    base = events.select((F.substring("session_id", 2, 20).cast("long") * 1000).alias("s"), F.col("event_id").cast("long").alias("e"))
    shifted = base.filter("e - s > 500").count()
    repeated = base.count() - base.distinct().count()
    assert events.count() - shifted - repeated == count["lineitem"]
    assert catalog.count() - catalog.filter("title like '%(Replay)'").count() == count["part"]
    assert tables["subscriptions"].count() == count["orders"]
    assert tables["users"].count() == count["customer"]
    lengths = events.groupBy("session_id").count().agg(F.min("count"), F.max("count")).first()
    assert lengths[0] < 8 and lengths[1] > 25
    changes = tables["subscriptions"].groupBy("subscription_id").count()
    assert {r["count"] for r in changes.collect()} == {1, 2, 3}
