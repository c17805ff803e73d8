"""Expressions on hand-computed inputs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyreel.functions import cleaning as C
from tallyreel.functions import numeric as N
from tallyreel.functions import timestamps as TS
from tallyreel.operators.classify import classify_threshold
from tallyreel.session import shuffle_partitions_for


def values(spark, rows, schema, expression):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    return [r[0] for r in df.coalesce(1).select(expression).collect()]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("1756693468", "2025-09-01 02:24:28"),
        ("2025-09-01T00:35:18Z", "2025-09-01 00:35:18"),
        ("2025-09-01 17:41:06", "2025-09-01 17:41:06"),
        ("2025-09-01T17:41:06", "2025-09-01 17:41:06"),
        ("2025-09-01", "2025-09-01 00:00:00"),
        ("2025-09-01 17:41", "2025-09-01 17:41:00"),
        ("2025-09-01 10:00:00.25", "2025-09-01 10:00:00.25"),
        ("2025-09", None),
        ("2025-09-01 10", None),
        ("2025-02-30 10:00:00", None),
        ("12:00:00", None),
        ("garbage", None),
        ("", None),
        (None, None),
        ("123\n", None),
        ("1756693468000", "+57637-05-26 07:46:40"),
        ("12345678901234567", None),
        ("99999999999999999999999", None),
        ("00000000001756693468", "2025-09-01 02:24:28"),
    ],
)
def test_normalize_timestamp(spark, text, expected):
    result = values(spark, [text], "t string", TS.normalize_timestamp(F.col("t")).cast("string"))
    assert result == [expected]


def test_iso_marker_test_equals_like(spark):
    rows = ["2025-09-01T00:35:18Z", "T", "Z", "TZ", "ZT", "T\nZ", "aTbZc", "ZTZ", "", None]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    assert df.filter(~TS.is_iso_utc_text(F.col("t")).eqNullSafe(F.col("t").like("%T%Z"))).count() == 0


def test_normalize_is_zone_free(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = values(spark, ["1756693468"], "t string", TS.normalize_timestamp(F.col("t")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [dt.datetime(2025, 9, 1, 2, 24, 28)]


def test_source_format(spark):
    rows = ["1756693468", "2025-09-01T00:35:18Z", "2025-09-01 17:41:06", "123\n", None]
    assert values(spark, rows, "t string", TS.timestamp_source_format(F.col("t"))) == [
        "epoch_seconds",
        "iso8601_utc",
        "iso8601_no_timezone_assumed_utc",
        "iso8601_no_timezone_assumed_utc",
        "iso8601_no_timezone_assumed_utc",
    ]


def test_boundaries_crossed(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2025-01-01 23:59:59' AS a, timestamp_ntz'2025-01-02 00:00:01' AS b, "
        "timestamp_ntz'2025-01-01 00:00:00.9' AS c, timestamp_ntz'2025-01-01 00:00:01.1' AS d, "
        "timestamp_ntz'1969-12-31 23:59:59.5' AS e"
    )
    row = df.select(
        TS.days_between(F.col("a"), F.col("b")).alias("days"),
        TS.seconds_between(F.col("c"), F.col("d")).alias("up"),
        TS.seconds_between(F.col("d"), F.col("c")).alias("down"),
        TS.seconds_between(F.col("e"), F.timestamp_add("SECOND", F.lit(1), F.col("e"))).alias("early"),
    ).first()
    assert tuple(row) == (1, 1, -1, 1)


def test_round_half_away(spark):
    rows = [1.005, 2.675, 0.285, -1.005, 2.5, None]
    assert values(spark, rows, "x double", N.round_half_away(F.col("x"), 2)) == [
        1.0,
        2.68,
        0.28,
        -1.0,
        2.5,
        None,
    ]
    assert values(spark, [2.5, -2.5, 0.49], "x double", N.round_half_away(F.col("x"), 0)) == [3.0, -3.0, 0.0]


def test_deciles(spark):
    rows = [0.0, 0.05, 0.95, 1.0, 4.2]
    assert values(spark, rows, "x double", N.decile_floor_then_clamp(F.col("x"))) == [0.0, 0.0, 0.9, 1.0, 1.0]
    assert values(spark, rows, "x double", N.decile_clamp_then_floor(F.col("x"))) == [0.0, 0.0, 0.9, 1.0, 1.0]


def test_map_category(spark):
    sports = values(spark, [" VB ", "fb", "Hockey", None], "s string", C.map_category(F.col("s"), C.SPORT_ALIASES))
    assert sports == ["VOLLEYBALL", "FOOTBALL", "HOCKEY", None]
    states = values(spark, ["Ga.", "tx", "Florida"], "s string", C.map_category(F.col("s"), C.STATE_ALIASES))
    assert states == ["GA", "TX", "FL"]


def test_null_out_below(spark):
    rows = [-600.0, -1.0, 0.0, 0.5, 1.0, None]
    assert values(spark, rows, "x double", C.null_out_below(F.col("x"), 1.0)) == [None] * 4 + [1.0, None]
    assert values(spark, rows, "x double", C.is_below(F.col("x"), 1.0)) == [True] * 4 + [False, None]


def test_surrogate_key(spark):
    rows = [("1", "a"), ("1", None), (None, "1"), ("1", "")]
    keys = values(spark, rows, "a string, b string", C.surrogate_key([F.col("a"), F.col("b")]))
    assert len(set(keys)) == 4 and all(len(k) == 32 for k in keys)
    assert keys == values(spark, rows, "a string, b string", C.surrogate_key([F.col("a"), F.col("b")]))


def test_replay_flag(spark):
    rows = ["Game (Replay)", " Game (Replay) ", "Game (Replay) 2", None]
    assert values(spark, rows, "t string", C.replay_flag(F.col("t"))) == [True, True, False, None]


def test_billing_months(spark):
    rows = ["monthly", "annual", "free_trial", "weekly", None]
    assert values(spark, rows, "p string", C.billing_months(F.col("p"))) == [1, 12, 0, None, None]


def test_hard_cast_fails_soft_cast_does_not(spark):
    assert values(spark, ["x1"], "t string", C.numeric_or_null(F.col("t"))) == [None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, ["x1"], "t string", F.col("t").cast("bigint"))


def test_classify_threshold(spark):
    cuts = [(0.10, "abandoned"), (0.30, "sampled")]
    rows = [0.0999, 0.10, 0.2999, 0.30, None]
    assert values(spark, rows, "x double", classify_threshold(F.col("x"), cuts, "engaged")) == [
        "abandoned",
        "sampled",
        "sampled",
        "engaged",
        "engaged",
    ]


def test_shuffle_partitions():
    assert shuffle_partitions_for(0, 8) == 8
    assert shuffle_partitions_for(129 * 1024 * 1024, 1) == 2
    assert shuffle_partitions_for(100 * 10**12, 4000) > 700_000
