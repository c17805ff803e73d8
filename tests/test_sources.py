"""Landing, seeds, sinks and the full build."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyreel import catalog
from tallyreel.config import standard_config
from tallyreel.plans import marts_data as MD
from tallyreel.plans import marts_product as MP
from tallyreel.plans.build import DATA_MARTS, PRODUCT_MARTS, ChecksFailed, Models, build
from tallyreel.profiling import sequences as SEQ
from tallyreel.quality import declared as D
from tallyreel.quality.suite import run_declared
from tallyreel.sources import raw as R
from tallyreel.sources import workspace
from tallyreel.sources.sample_feed import landed_sample, raw_playback_events
from tallyreel.sources.sinks import write_mart

SF_DIR = "/root/testdata/sf0.001"


def test_csv_stays_text(spark, tmp_path):
    text = 'user_id,signup_ts,home_state,acquisition_channel\n007,1756693468,"Ga., ",\n8,,"", x \n'
    (tmp_path / "users.csv").write_text(text)
    df = R.read_raw_csv(spark, str(tmp_path / "users.csv"), R.RAW_COLUMNS["users"])
    assert set(df.dtypes) == {(c, "string") for c in R.RAW_COLUMNS["users"]}
    assert [tuple(r) for r in df.collect()] == [
        ("007", "1756693468", "Ga., ", None),
        ("8", None, None, " x "),
    ]


def test_csv_with_other_columns_fails(spark, tmp_path):
    (tmp_path / "users.csv").write_text("user_id,home_state\n1,FL\n")
    with pytest.raises(Exception):
        R.read_raw_csv(spark, str(tmp_path / "users.csv"), R.RAW_COLUMNS["users"]).collect()


def test_missing_extract_fails(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        R.read_extracts(spark, str(tmp_path / "nowhere"))


def test_land_tables_refreshes(spark):
    raw = landed_sample(spark, SF_DIR)
    R.land_raw_tables({"users": raw["users"], "asset_catalog": raw["asset_catalog"]}, "raw_test")
    assert spark.catalog.tableExists("raw_test.asset_catalog")
    for _ in range(2):
        R.land_raw_tables({"users": raw["users"]}, "raw_test")
    assert spark.table("raw_test.users").count() == 150
    assert not spark.catalog.tableExists("raw_test.asset_catalog")


def test_a_query_lands_only_what_it_reads(spark, tmp_path):
    rows = [("1", "7", "2025-03-01"), ("1", "7", "2025-05-01"), ("2", "7", "2025-04-01"), ("2", None, "2025-04-01"), (None, "7", "")]
    subs = spark.createDataFrame(rows, "subscription_id string, user_id string, event_effective_ts string")
    empty = {name: spark.createDataFrame([], R.text_schema(columns)) for name, columns in R.RAW_COLUMNS.items()}
    tables = R.LandedOnDemand({**empty, "subscriptions": subs}, {**empty, "subscriptions": subs}, str(tmp_path), 2)
    assert set(tables) == set(R.RAW_COLUMNS) and "users" in tables and not list(tmp_path.iterdir())
    models = Models(R.RawTables(tables, R.standard_rates(spark), 100), standard_config())
    pairs = catalog.PLANS["overlapping_pairs_list"](models, "")
    assert [(r["user_id"], r["sub_a"], r["sub_b"]) for r in pairs.collect()] == [("7", "1", "2")]
    assert [path.name for path in tmp_path.iterdir()] == ["subscriptions"]


def test_ordered_events_move_only_what_the_order_needs(spark, tmp_path):
    """Copies that tie in session, time and position: the same one stays as with all columns."""
    base = ("10", "s1", "7", "4", "buffer", "1756684800", "60", "web", "5.0", "800")
    rows = [
        base,
        (*base[:4], "stop", *base[5:]),
        (*base[:2], "5", "9", "pause", *base[5:]),
        (*base[:2], None, "1", "play", *base[5:]),
        (*base[:7], "ios", "5.1", "900"),
        (*base[:1], "s0", *base[2:]),
        ("11", *base[1:6], None, *base[7:]),
        ("12", None, *base[2:5], "2025-09-01T00:01:00Z", *base[6:]),
        ("12", None, *base[2:5], "2025-09-01T00:01:00Z", *base[6:]),
        (None, *base[1:]),
        (None, *base[1:5], None, *base[6:]),
    ]
    spark.createDataFrame(rows, R.text_schema(R.RAW_COLUMNS["playback_events"])).write.parquet(str(tmp_path / "events"))
    tables = {"playback_events": spark.read.parquet(str(tmp_path / "events"))}
    models = Models(R.RawTables(tables, R.standard_rates(spark), 100), standard_config())
    narrow = models.ordered_events
    assert sorted(narrow.collect(), key=str) == sorted(models.stg_playback_events.select(*narrow.columns).collect(), key=str)
    plan = catalog.PLANS["profile_after_buffer"](models, "")._jdf.queryExecution().executedPlan().toString()
    assert "event_type" in plan and "bitrate_kbps" not in plan and "device_type" not in plan


def test_sample_events_repeat_and_shift(spark, tmp_path):
    lines = [(10 * i + i % 9, n, 1, 1, 1.0, 1.0) for i in range(60) for n in range(30)] + [(11, 3, 1, 1, 1.0, 1.0)] * 2
    names = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    spark.createDataFrame(lines, ", ".join(f"{n} {'double' if 'price' in n or 'quant' in n else 'long'}" for n in names)).write.parquet(
        str(tmp_path / "lineitem.parquet")
    )
    for table, key in (("customer", "c_custkey"), ("part", "p_partkey")):
        spark.range(50).withColumnRenamed("id", key).write.parquet(str(tmp_path / f"{table}.parquet"))
    events = raw_playback_events(spark, str(tmp_path))
    sizes = Counter(k // 10 * 2 + (k % 10 > 1 + k // 10 % 7) for k, *_ in lines)
    want = Counter()
    for s, size in sizes.items():
        for rn in range(1, size + 1):
            e = s * 1000 + rn
            beat = rn not in (1, size) and rn % 11 and rn % 13
            want.update(str(e + shift) for shift in [0] + [0] * (e % 97 == 0) + [500] * bool(e % 89 == 0 and beat))
    assert Counter(r["event_id"] for r in events.collect()) == want
    # Row number and size of a session come from one pass over its rows.
    assert events._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1


def test_order_of_input_does_not_matter(spark):
    """Other partitioning and row order, same tables: nothing depends on arrival order."""
    raw = landed_sample(spark, SF_DIR)
    mixed = {name: df.repartition(5, F.rand(3)) for name, df in raw.tables.items()}
    config = standard_config()
    usual, other = Models(raw, config), Models(R.RawTables(mixed, raw.rates, raw.max_group_rows), config)
    for name in ("stg_playback_events", "fct_user_paid_spells", "fct_session", "dim_user"):
        left, right = getattr(usual, name), getattr(other, name)
        assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_landing_report(spark):
    raw = landed_sample(spark, SF_DIR)
    report = {r["table_name"]: (r["row_count"], r["column_count"]) for r in R.landing_report(raw.tables).collect()}
    assert report == {
        "playback_events": (6119, 10),
        "subscriptions": (1500, 7),
        "asset_catalog": (207, 8),
        "users": (150, 4),
    }


def test_seed_from_csv(spark, tmp_path):
    standard = R.standard_rates(spark)
    path = str(tmp_path / "fx")
    standard.write.option("header", True).csv(path)
    loaded = R.load_seed(spark, path)
    assert loaded.schema.simpleString() == R.RATE_SCHEMA.simpleString()
    assert sorted(map(tuple, loaded.collect())) == sorted(map(tuple, standard.collect()))


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        applicationId = "app-without-folder"
        master = "yarn"

    class Conf:
        @staticmethod
        def get(key, default):
            return None

    class Session:
        sparkContext = Context
        conf = Conf

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_folder(Session)


def test_landing_lies_below_the_configured_folder(spark):
    assert workspace.shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_build_writes_documented_marts(spark, tmp_path):
    raw = landed_sample(spark, SF_DIR)
    config = standard_config()
    built = build(raw, config, str(tmp_path / "marts"))
    lazy = Models(raw, config)
    for name in [*DATA_MARTS, *PRODUCT_MARTS]:
        written, computed = getattr(built, name), getattr(lazy, name)
        assert written.columns == computed.columns
        assert written.exceptAll(computed).count() == 0 and computed.exceptAll(written).count() == 0
    for fact in (built.fct_session, built.fct_session_engagement):
        plan = fact.filter("session_date = date'2025-09-03'")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(session_date" in plan
    comments = {r["col_name"]: r["comment"] for r in spark.sql("DESCRIBE marts_data.fct_session").collect()}
    assert comments["watch_minutes"].startswith("Number of different playhead positions")
    failing = run_declared(lambda t: getattr(built, t), [*D.DATA_CHECKS, *D.PRODUCT_CHECKS])
    assert failing.filter(F.col("failing_rows") > 0).count() == 0


def test_a_failing_check_stops_the_build(spark, tmp_path):
    """CSV to landed tables to checked marts; a repeated account stops it before any mart is written."""
    source = landed_sample(spark, SF_DIR)
    for name in R.RAW_COLUMNS:
        R.write_raw_csv(source[name], str(tmp_path / f"{name}.csv"))
    landed = R.land_raw(R.read_extracts(spark, str(tmp_path)), str(tmp_path / "raw"))
    raw = R.RawTables(landed, R.standard_rates(spark), source.max_group_rows)
    suites = {"staging": D.SEED_CHECKS}
    built = build(raw, standard_config(), str(tmp_path / "good"), check=True, suites=suites)
    assert built.fct_user_engagement.count() == 150
    twice = {**landed, "users": landed["users"].union(landed["users"].limit(1))}
    bad = R.RawTables(twice, R.standard_rates(spark), source.max_group_rows)
    spark.sql("DROP NAMESPACE marts_product CASCADE")
    with pytest.raises(ChecksFailed, match="user_id: unique"):
        build(bad, standard_config(), str(tmp_path / "bad"), check=True, suites=suites)
    assert not spark.catalog.tableExists("marts_product.fct_user_engagement")


def test_bucketed_events_need_no_shuffle(spark, tmp_path):
    """Events written by session: ordered profiles and the session roll-up read them in place."""
    raw = landed_sample(spark, SF_DIR)
    events = Models(raw, standard_config()).stg_playback_events
    written = write_mart(events, "staging_bucketed", "events", str(tmp_path / "b"), bucket_by="session_id")
    assert written.exceptAll(events).count() == 0 and events.exceptAll(written).count() == 0
    profile = SEQ.divergence_summary(written, None)
    plan = profile._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(session_id" not in plan
    assert profile.collect() == SEQ.divergence_summary(events, None).collect()


def test_built_tables_of_users_need_no_shuffle(spark, tmp_path):
    """Histories, spells and accounts are laid out by user; only staged accounts and session measures move."""
    raw = landed_sample(spark, SF_DIR)
    built = build(raw, standard_config(), str(tmp_path / "users"))
    lazy = Models(raw, standard_config())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spells = MD.fct_user_paid_spells(built.dim_subscription_history, standard_config(), None)
        users = MD.dim_user(built.stg_users, built.dim_subscription_history, built.fct_user_paid_spells)
        engagement = MP.fct_user_engagement(built.dim_user, built.fct_session, standard_config())
        moved = {}
        for name, df in (("spells", spells), ("users", users), ("engagement", engagement)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            moved[name] = plan.count("hashpartitioning(user_id")
        assert moved == {"spells": 0, "users": 1, "engagement": 2}
        for df, want in ((spells, lazy.fct_user_paid_spells), (users, lazy.dim_user), (engagement, lazy.fct_user_engagement)):
            assert df.exceptAll(want).count() == 0 and want.exceptAll(df).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partitioned_mart_prunes(spark, tmp_path):
    sessions = Models(landed_sample(spark, SF_DIR), standard_config()).fct_session
    written = write_mart(sessions, "by_day", "sessions", str(tmp_path / "p"), partition_by="session_date")
    one_day = written.filter("session_date = date'2025-09-03'")
    assert "PartitionFilters: [isnotnull(session_date" in one_day._jdf.queryExecution().executedPlan().toString()
    assert one_day.count() == sessions.filter("session_date = date'2025-09-03'").count() > 0
