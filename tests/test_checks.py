"""Every check passes on good data and fires on bad data."""

import pytest

from tallyreel.quality import checks as Q
from tallyreel.quality import declared as D
from tallyreel.quality.suite import run_declared


def count(df):
    return df.count()


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, v string")


def test_not_null(table):
    assert count(Q.check_not_null(table, "id")) == 0
    assert count(Q.check_not_null(table, "v")) == 1


def test_unique(table):
    assert count(Q.check_unique(table, "id")) == 0
    twice = table.unionByName(table)
    assert count(Q.check_unique(twice, "id")) == 3
    assert count(Q.check_unique(twice, "v")) == 2  # NULLs are not compared


def test_accepted_values(table):
    assert count(Q.check_accepted_values(table, "v", ["a", "b"])) == 0
    assert count(Q.check_accepted_values(table, "v", ["a"])) == 1


def test_relationships(table):
    parent = table.withColumnRenamed("v", "w")
    assert count(Q.check_relationships(table, "v", parent, "w")) == 0
    assert count(Q.check_relationships(table, "v", parent.filter("id = 1"), "w")) == 1


def test_unique_combination(table):
    assert count(Q.check_unique_combination(table, ["id", "v"])) == 0
    assert count(Q.check_unique_combination(table.unionByName(table), ["id", "v"])) == 3


def test_expression(table):
    assert count(Q.check_expression(table, "length(v) = 1")) == 0
    assert count(Q.check_expression(table, "v = 'a'")) == 1


def test_range_check_catches_milliseconds(spark):
    df = spark.sql(
        "SELECT timestampadd(SECOND, 1756693468000L, timestamp_ntz'1970-01-01 00:00:00') AS event_at_utc "
        "UNION ALL SELECT timestamp_ntz'2025-09-01 00:00:00'"
    )
    assert count(Q.check_expression(df, D.EVENT_RANGE)) == 1


def test_collapse_columns_agree(spark):
    schema = (
        "asset_id int, sport string, home_school string, away_school string, "
        "scheduled_start_at_utc timestamp_ntz, duration_seconds double"
    )
    good = spark.createDataFrame([(1, "A", "h", "a", None, 6.0)] * 2 + [(2, "B", "h", "a", None, None)], schema)
    assert count(Q.assert_collapse_columns_agree(good)) == 0
    bad = good.unionByName(spark.createDataFrame([(2, "B", "h", "a", None, 5.0)], schema))
    failing = Q.assert_collapse_columns_agree(bad).collect()
    assert [(r["asset_id"], r["catalog_rows"], r["distinct_durations"]) for r in failing] == [(2, 2, 2)]


def test_duplicates_identical(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", None), (2, "b", "x")], "event_id int, s string, u string")
    assert count(Q.assert_duplicates_identical(df)) == 0
    bad = df.unionByName(spark.createDataFrame([(2, "b", None), (1, "a", None)], df.schema))
    assert [tuple(r) for r in Q.assert_duplicates_identical(bad).collect()] == [(2, 2, 2)]


def test_row_reconciliation(spark):
    raw = spark.createDataFrame([(1,), (1,), (2,)], "event_id int")
    assert count(Q.assert_row_reconciliation(raw, raw.distinct())) == 0
    assert count(Q.assert_row_reconciliation(raw, raw.limit(1))) == 1


def test_rowcount_equal(table):
    assert count(Q.assert_rowcount_equal({"a": (table, table), "b": (table, table)})) == 0
    failing = Q.assert_rowcount_equal({"a": (table, table), "b": (table, table.unionByName(table))}).collect()
    assert [(r["model_name"], r["row_delta"]) for r in failing] == [("b", 3)]


def test_exclusions_reconcile(spark):
    events = spark.createDataFrame([("s1", 1), ("s1", 1), ("s2", 2), ("s3", 9)], "session_id string, asset_id int")
    assets = spark.createDataFrame([(1, 60.0), (2, None)], "asset_id int, duration_seconds double")
    sessions = spark.createDataFrame([("s1",)], "session_id string")
    assert count(Q.assert_exclusions_reconcile(events, assets, sessions)) == 0
    assert count(Q.assert_exclusions_reconcile(events, assets, sessions.limit(0))) == 1


def test_windows_contiguous(spark):
    schema = "subscription_id int, valid_from int, valid_to int, subscription_change_key string"
    good = spark.createDataFrame([(1, 1, 5, "a"), (1, 5, 9, "b"), (2, 1, 9, "c")], schema)
    assert count(Q.assert_windows_contiguous(good)) == 0
    gap = good.unionByName(spark.createDataFrame([(2, 10, 12, "d")], schema))
    assert count(Q.assert_windows_contiguous(gap)) == 1


def test_intervals_no_overlap(spark):
    schema = "k int, s int, e int, n int"
    good = spark.createDataFrame([(1, 1, 5, 1), (1, 5, 9, 2), (2, 1, 9, 1)], schema)
    assert count(Q.assert_intervals_no_overlap(good, "k", "s", "e", "n")) == 0
    nested = good.unionByName(spark.createDataFrame([(2, 3, 4, 2), (2, 6, 7, 3)], schema))
    assert count(Q.assert_intervals_no_overlap(nested, "k", "s", "e", "n")) == 2


def test_overlapping_rate_periods_are_caught(spark):
    rates = spark.createDataFrame([("USD", 1, 9, "a"), ("USD", 5, 12, "b")], "currency string, f int, t int, n string")
    assert count(Q.assert_intervals_no_overlap(rates, "currency", "f", "t", "n")) == 1


def test_spine_grain(spark):
    users = spark.createDataFrame([(1,), (2,)], "user_id int")
    fact = spark.createDataFrame([(1, 2), (2, 0)], "user_id int, session_count long")
    sessions = spark.createDataFrame(
        [(1, False), (1, False), (None, False), (9, True)], "user_id int, has_unknown_user boolean"
    )
    assert count(Q.assert_spine_grain(fact, users, sessions)) == 0
    assert count(Q.assert_spine_grain(fact.unionByName(fact.limit(1)), users, sessions)) == 1
    # A missing sum is a failure, not an unknown.
    assert count(Q.assert_spine_grain(fact.limit(0), users.limit(0), sessions)) == 1


def test_declared_counts():
    suites = {
        "source": D.source_checks(),
        "staging": D.STAGING_CHECKS,
        "seed": D.SEED_CHECKS,
        "data": D.DATA_CHECKS,
        "product": D.PRODUCT_CHECKS,
    }
    counts = {name: sum(d.count() for d in suite) for name, suite in suites.items()}
    assert counts == {"source": 26, "staging": 39, "seed": 5, "data": 43, "product": 22}


def test_declared_suite_fires(spark):
    good = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, v string, p int")
    parent = spark.createDataFrame([(1,), (2,)], "p int")
    suite = [
        D.Declared(
            "t",
            ["id"],
            {"v": ["a", "b"]},
            unique=["id"],
            unique_together=[["id", "v"]],
            relationships=[("p", "parent", "p")],
            expressions=["id > 0"],
        )
    ]

    def failing(df):
        report = run_declared({"t": df, "parent": parent}.get, suite)
        return {r["check_name"]: r["failing_rows"] for r in report.collect()}

    assert set(failing(good).values()) == {0}
    bad = spark.createDataFrame(
        [(1, "a", 1), (1, "a", 1), (None, "z", 3), (-1, "b", None)], "id int, v string, p int"
    )
    assert failing(bad) == {
        "t.id: not_null": 1,
        "t.v: accepted_values": 1,
        "t: expression 1": 1,
        "t.id: unique": 1,
        "t.(id, v): unique_combination": 1,
        "t.p: relationships parent": 1,
    }


def test_colliding_digests_are_not_failures(spark):
    """xxhash64 leaves NULLs out, so (NULL, 'a') and ('a', NULL) share a digest; only equal values fail."""
    rows = [(None, "a"), ("a", None), ("b", "c"), ("b", "c"), ("b", "c"), (None, None), (None, None), ("d", "e")]
    df = spark.createDataFrame(rows, "x string, y string")
    suite = [D.Declared("t", ["x"], unique=["x", "y"], unique_together=[["x", "y"]])]
    report = {r["check_name"]: r["failing_rows"] for r in run_declared({"t": df}.get, suite).collect()}
    assert report == {"t.x: not_null": 3, "t.x: unique": 1, "t.y: unique": 1, "t.(x, y): unique_combination": 2}


def final_plan(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[: plan.index("Initial Plan")]


def test_one_scan_a_table_where_keys_are_unique(spark, tmp_path):
    """The second scan, of repeated digests, is planned but drops out at run time; with repeats, the first is used twice."""
    spark.range(1000).selectExpr("id", "concat('v', id) v", "id % 7 w").write.parquet(str(tmp_path / "t"))
    suite = [D.Declared("t", ["id", "v"], {"w": list(range(7))}, unique=["id", "v"], unique_together=[["v", "w"], ["id", "w"]])]
    report = run_declared({"t": spark.read.parquet(str(tmp_path / "t"))}.get, suite)
    assert {r["failing_rows"] for r in report.collect()} == {0}
    assert "LeftSemi" not in final_plan(report)
    spark.range(3).selectExpr("id", "'v0' v", "id % 7 w").write.mode("append").parquet(str(tmp_path / "t"))
    report = run_declared({"t": spark.read.parquet(str(tmp_path / "t"))}.get, suite)
    counts = {r["check_name"]: r["failing_rows"] for r in report.collect()}
    assert counts["t.id: unique"] == 3 and counts["t.v: unique"] == 1 and counts["t.(id, w): unique_combination"] == 3
    assert final_plan(report).count("FileScan") == 2 and "ReusedExchange" in final_plan(report)
