"""Line breaks inside quotes, with one file read by many tasks: Spark and DuckDB agree."""

import random

import duckdb
import pytest

from tallyreel.sources import raw as R

COLUMNS = ["user_id", "signup_ts", "home_state", "acquisition_channel"]
HEAD = ",".join(COLUMNS)


@pytest.fixture(params=[200, 1 << 27])
def split(spark, request):
    """Byte ranges of 200 bytes and of everything."""
    size, cost = (spark.conf.get(f"spark.sql.files.{c}") for c in ("maxPartitionBytes", "openCostInBytes"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    yield request.param
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


def in_duckdb(path):
    text = f"""SELECT * FROM read_csv('{path}', header = true, all_varchar = true, quote = '"', escape = '"', delim = ',',
               parallel = false, auto_detect = false, columns = {{{", ".join(f"'{c}': 'VARCHAR'" for c in COLUMNS)}}})"""
    return duckdb.sql(text).fetchall()


def plain(rows):
    return sorted(tuple("\0" if v is None else v for v in r) for r in rows)


def field(draw):
    kind = draw.randrange(8)
    if kind < 3:
        return "v" + str(draw.randrange(1000))
    if kind == 3:
        return '5" pipe'
    body = "".join(draw.choice(["a", "b c", ",", "\n", '""', "\\", "é", "1,", '"",""', "\n\n"]) for _ in range(draw.randrange(1, 12)))
    return f'"{body}x"'


@pytest.mark.parametrize("seed", range(3))
def test_values_over_several_lines(spark, tmp_path, split, seed):
    draw = random.Random(seed)
    rows = [",".join([str(i), field(draw), field(draw), field(draw)]) for i in range(120)]
    (tmp_path / "users.csv").write_text(HEAD + "\n" + "\n".join(rows) + "\n")
    df = R.read_raw_csv(spark, str(tmp_path / "users.csv"), COLUMNS)
    got = df.collect()
    assert len(got) == 120 and sorted(int(r["user_id"]) for r in got) == list(range(120))
    # What each field spells, quotes taken off.
    import csv
    import io

    with io.StringIO(HEAD + "\n" + "\n".join(rows) + "\n", newline="") as text:
        wanted = list(csv.reader(text))[1:]
    assert plain(got) == plain(wanted)


def test_same_rows_as_duckdb(spark, tmp_path, split):
    draw = random.Random(9)
    bodies = ['"one\ntwo"', '"a ""quoted\n"" word"', '"x,\n"",""\ny"', '""""', "plain", '"\n"', '"tail\n\n"']
    rows = [f"{i},{draw.choice(bodies)},{draw.choice(bodies)},z{i}" for i in range(300)]
    path = tmp_path / "users.csv"
    path.write_text(HEAD + "\n" + "\n".join(rows) + "\n")
    assert plain(R.read_raw_csv(spark, str(path), COLUMNS).collect()) == plain(in_duckdb(path))


def test_carriage_returns(spark, tmp_path, split):
    rows = [f'{i},"first\r\nsecond, ""{i}""\r\n",GA,z' for i in range(60)]
    path = tmp_path / "users.csv"
    path.write_bytes((HEAD + "\r\n" + "\r\n".join(rows) + "\r\n").encode())
    got = plain(R.read_raw_csv(spark, str(path), COLUMNS).collect())
    assert got == plain([(str(i), f'first\r\nsecond, "{i}"\r\n', "GA", "z") for i in range(60)])
    assert got == plain(in_duckdb(path))


def test_one_record_over_many_ranges_and_several_files(spark, tmp_path, split):
    folder = tmp_path / "users.csv"
    folder.mkdir()
    long = "\n".join(f"line {i}" for i in range(400))
    (folder / "a.csv").write_text(f'{HEAD}\n1,"{long}",GA,x\n\n2,"b\nc",TX,\n')
    (folder / "b.csv").write_text(f'{HEAD}\n3,plain,FL,"y\n"\n')
    got = R.read_raw_csv(spark, str(folder), COLUMNS).orderBy("user_id").collect()
    assert [tuple(r) for r in got] == [("1", long, "GA", "x"), ("2", "b\nc", "TX", None), ("3", "plain", "FL", "y\n")]
    assert R.read_raw_csv(spark, str(folder), COLUMNS).select("home_state").distinct().count() == 3


def test_what_is_broken_fails(spark, tmp_path, split):
    path = tmp_path / "users.csv"
    path.write_text(f'{HEAD}\n1,"open\n2,never closed,GA,x\n')
    with pytest.raises(ValueError, match="never closed"):
        R.read_raw_csv(spark, str(path), COLUMNS)
    path.write_text(f'user_id,other,home_state,acquisition_channel\n1,"a\nb",GA,x\n')
    with pytest.raises(Exception, match="header does not conform"):
        R.read_raw_csv(spark, str(path), COLUMNS).collect()
    path.write_text(f'{HEAD}\n1,"a\nb",GA\n')
    with pytest.raises(Exception, match="MALFORMED"):
        R.read_raw_csv(spark, str(path), COLUMNS).collect()


def test_written_values_come_back(spark, tmp_path, split):
    rows = [("1", "a\nb", ' "quoted"\n', "x\\"), ("2", "\n", "c\r\nd", ","), ("3", None, "e", " f ")]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLUMNS))
    R.write_raw_csv(df, str(tmp_path / "users.csv"))
    assert plain(R.read_raw_csv(spark, str(tmp_path / "users.csv"), COLUMNS).collect()) == plain(rows)
