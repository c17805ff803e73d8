"""Readers find the old table or the new one, never a part of either."""

import pytest
from pyspark.sql import functions as F

from tallyreel.config import standard_config
from tallyreel.plans.build import ChecksFailed, build
from tallyreel.quality import declared as D
from tallyreel.sources import publish as P
from tallyreel.sources import raw as R
from tallyreel.sources.sample_feed import landed_sample
from tallyreel.sources.sinks import documented_columns, persist_docs, write_mart

SF = "/root/testdata/sf0.001"


def broken(df):
    """Some tasks write their file before another one fails."""
    return df.repartition(4).withColumn("x", F.when(F.col("id") == 77, F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("x")))


@pytest.fixture
def numbers(spark):
    return spark.range(100).select("id", (F.col("id") * 2).alias("x"))


@pytest.mark.parametrize("layout", [{}, {"partition_by": "x"}, {"bucket_by": "id"}])
def test_a_killed_write_leaves_the_old_table(spark, tmp_path, numbers, layout):
    name = "killed_" + "".join(layout) + ".t"
    namespace = name.split(".")[0]
    write_mart(numbers, namespace, "t", str(tmp_path), **layout)
    with pytest.raises(Exception, match="killed"):
        write_mart(broken(numbers), namespace, "t", str(tmp_path), **layout)
    assert sorted(spark.table(name).collect()) == sorted(numbers.collect())
    write_mart(numbers.filter("id < 3"), namespace, "t", str(tmp_path), **layout)
    assert spark.table(name).count() == 3


def test_a_started_reader_keeps_its_version(spark, tmp_path, numbers):
    write_mart(numbers, "kept", "t", str(tmp_path))
    reader = spark.table("kept.t")
    write_mart(numbers.filter("id < 5").withColumn("y", F.lit("new")), "kept", "t", str(tmp_path))
    assert reader.count() == 100 and reader.columns == ["id", "x"]
    assert spark.table("kept.t").columns == ["id", "x", "y"] and spark.table("kept.t").count() == 5
    write_mart(numbers.limit(1), "kept", "t", str(tmp_path))
    write_mart(numbers.limit(2), "kept", "t", str(tmp_path))
    # The current version and the one before it stay, in the catalog and on disk.
    assert spark.sql("SHOW TABLES IN kept__versions").filter("not isTemporary").count() == 2
    assert len(list((tmp_path / "t").iterdir())) == 2


def test_a_failing_check_is_never_published(spark, tmp_path, numbers):
    def no_rows(df):
        if not df.take(1):
            raise ValueError("empty")

    write_mart(numbers, "checked", "t", str(tmp_path), check=no_rows)
    with pytest.raises(ValueError, match="empty"):
        write_mart(numbers.limit(0), "checked", "t", str(tmp_path), check=no_rows)
    assert spark.table("checked.t").count() == 100


def test_descriptions_and_plain_tables_of_earlier_releases(spark, tmp_path, numbers):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS older")
    numbers.write.mode("overwrite").saveAsTable("older.t")
    write_mart(numbers, "older", "t", str(tmp_path))
    persist_docs(spark, "older.t", "It's a table", {"x": "twice the id"})
    comments = {r["col_name"]: r["comment"] for r in documented_columns(spark, "older.t").collect()}
    assert comments["x"] == "twice the id" and not comments["id"]
    rows = spark.sql("DESCRIBE TABLE EXTENDED older.t").filter("col_name = 'Comment'").collect()
    assert rows[0]["data_type"] == "It's a table"
    P.withdraw(spark, "older", "t")
    assert not spark.catalog.tableExists("older.t") and spark.sql("SHOW TABLES IN older__versions").filter("not isTemporary").count() == 0


def test_landing_switches_after_all_tables_are_written(spark, tmp_path):
    raw = landed_sample(spark, SF).tables
    R.land_raw(raw, str(tmp_path))
    bad = {**raw, "users": raw["users"].withColumn("user_id", F.raise_error(F.lit("killed")))}
    with pytest.raises(Exception, match="killed"):
        R.land_raw({n: df.limit(0) if n != "users" else df for n, df in bad.items()}, str(tmp_path))
    now = R.landed_tables(spark, str(tmp_path))
    assert {n: df.count() for n, df in now.items()} == {n: df.count() for n, df in raw.items()}
    R.land_raw({"users": raw["users"].limit(7)}, str(tmp_path))
    assert {n: df.count() for n, df in R.landed_tables(spark, str(tmp_path)).items()} == {"users": 7}
    R.land_raw_tables(dict(raw), "raw_switch")
    with pytest.raises(Exception, match="killed"):
        R.land_raw_tables(bad, "raw_switch")
    assert spark.table("raw_switch.users").count() == raw["users"].count()


def test_a_failing_layer_is_not_published(spark, tmp_path):
    raw, config = landed_sample(spark, SF), standard_config()
    suites = {"staging": D.SEED_CHECKS, "marts_data": D.DATA_CHECKS[:1], "marts_product": D.PRODUCT_CHECKS[:1]}
    build(raw, config, str(tmp_path / "b"), check=True, suites=suites)
    before = P.current_version(spark, "marts_data", "dim_user")
    users = raw.tables["users"]
    twice = R.RawTables({**raw.tables, "users": users.union(users.limit(1))}, raw.rates, raw.max_group_rows)
    with pytest.raises(ChecksFailed):
        build(twice, config, str(tmp_path / "b"), check=True, suites={"staging": D.SEED_CHECKS, "marts_data": D.DATA_CHECKS})
    assert P.current_version(spark, "marts_data", "dim_user") == before
