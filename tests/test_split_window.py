"""Hot groups: cut into pieces or not, the values must be the same."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyreel.operators import split_window
from tallyreel.operators.history import scd2_windows
from tallyreel.operators.intervals import containing_pairs, label_islands, overlap_partners, overlapping_after_merge
from tallyreel.operators.split_window import (
    Lag,
    Lead,
    PriorMax,
    RowNumber,
    RunningSum,
    find_hot_groups,
    ordered_columns,
)

SPECS = {
    "lag": Lag("v"),
    "lead": Lead("v"),
    "prior_max": PriorMax("v"),
    "running": RunningSum("v"),
    "number": RowNumber(),
}


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with a third of all rows, a NULL key with another hot share, many small keys."""
    rng = random.Random(7)
    rows = []
    for i in range(900):
        key = 1 if i % 3 == 0 else None if i % 5 == 0 else rng.randint(2, 60)
        value = None if rng.random() < 0.1 else rng.randint(-50, 50)
        rows.append((key, rng.randint(0, 40), i, value))
    return spark.createDataFrame(rows, "k long, t int, id int, v long").repartition(7).cache()


def brute_force(rows):
    groups = {}
    for k, t, i, v in rows:
        groups.setdefault(k, []).append((t, i, v))
    out = set()
    for k, members in groups.items():
        members.sort()
        for n, (t, i, v) in enumerate(members):
            before = [m[2] for m in members[:n] if m[2] is not None]
            upto = before + ([v] if v is not None else [])
            lag = members[n - 1][2] if n else None
            lead = members[n + 1][2] if n + 1 < len(members) else None
            out.add((k, t, i, v, lag, lead, max(before, default=None), sum(upto) if upto else None, n + 1))
    return out


def test_plain_and_pieces_match_brute_force(skewed):
    expected = brute_force([tuple(r) for r in skewed.collect()])
    hot = find_hot_groups(skewed, ["k"], 20)
    assert {r["k"] for r in hot.keys.collect()} >= {1, None}
    assert hot.pieces > 10
    for groups in (None, hot):
        result = ordered_columns(skewed, ["k"], ["t", "id"], SPECS, groups)
        assert {tuple(r) for r in result.collect()} == expected


def test_no_hot_groups(skewed):
    assert find_hot_groups(skewed, ["k"], 900) is None


def test_hot_group_is_spread(skewed):
    """No task of the hot path sees more than a fraction of the hot key."""
    hot = find_hot_groups(skewed, ["k"], 20)
    one = skewed.filter("k = 1")
    placed = one.repartitionByRange(hot.pieces, "k", "t", "id").groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in placed.collect()) < one.count() / 4


def _intervals(spark, n=240, closed=True, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        start = rng.randint(0, 400)
        length = rng.randint(0 if closed else 1, 40)
        rows.append((1 if i % 3 == 0 else rng.randint(2, 12), i, start, start + length, i % 2 == 0))
    return spark.createDataFrame(rows, "k int, id int, s int, e int, flag boolean")


@pytest.mark.parametrize("closed", [True, False])
def test_overlap_partners_count_every_pair_once(spark, closed):
    df = _intervals(spark, closed=closed)
    rows = [tuple(r) for r in df.collect()]
    expected = {"both": 0, "mixed": 0, "neither": 0}
    for n, (k1, i1, s1, e1, f1) in enumerate(rows):
        for k2, i2, s2, e2, f2 in rows[n + 1 :]:
            meets = (s1 <= e2 and s2 <= e1) if closed else (s1 < e2 and s2 < e1)
            if k1 == k2 and meets:
                expected["both" if f1 and f2 else "mixed" if f1 or f2 else "neither"] += 1
    for groups in (None, find_hot_groups(df, ["k"], 25)):
        got = overlap_partners(df, "k", "id", "s", "e", "flag", closed, groups)
        found = {"both": 0, "mixed": 0, "neither": 0}
        for r in got.collect():
            found["both" if r["flag"] else "mixed"] += r["flagged_partners"]
            found["mixed" if r["flag"] else "neither"] += r["other_partners"]
        assert found == expected


def _merged(rows):
    spells = {}
    for k, s, e in sorted(rows):
        mine = spells.setdefault(k, [])
        if mine and s <= mine[-1][1]:
            mine[-1][1] = max(mine[-1][1], e)
            mine[-1][2] += 1
        else:
            mine.append([s, e, 1])
    return {(k, n + 1, *spell) for k, mine in spells.items() for n, spell in enumerate(mine)}


def test_islands_with_hot_key(spark):
    df = _intervals(spark, seed=11)
    expected = _merged([(r["k"], r["s"], r["e"]) for r in df.collect()])
    for groups in (None, find_hot_groups(df, ["k"], 25)):
        labelled = label_islands(df, "k", "s", "e", ["id"], "n", groups)
        spells = labelled.groupBy("k", "n").agg(F.min("s"), F.max("e"), F.count("*"))
        assert {tuple(r) for r in spells.collect()} == expected
        # Merging merged intervals changes nothing, and they are disjoint.
        merged = spells.toDF("k", "n", "s", "e", "c")
        assert overlapping_after_merge(merged, "k", "s", "e", ["n"]).count() == 0
        again = label_islands(merged.drop("n"), "k", "s", "e", ["c"], "n")
        assert again.groupBy("k", "n").count().count() == merged.count()


@pytest.mark.parametrize(
    ("windows", "expected"),
    [
        ([(1, 10), (2, 3), (4, 5), (10, 12), (13, 14)], {(1, 1, 12, 4), (2, 13, 14, 1)}),
        ([(1, 5), (1, 9), (8, 10)], {(1, 1, 10, 3)}),
        ([(1, 9), (8, 10), (1, 5)], {(1, 1, 10, 3)}),
        ([(1, 5), (6, 999)], {(1, 1, 5, 1), (2, 6, 999, 1)}),
    ],
)
def test_islands_by_hand(spark, windows, expected):
    df = spark.createDataFrame([(7, s, e, i) for i, (s, e) in enumerate(windows)], "u int, s int, e int, id int")
    labelled = label_islands(df, "u", "s", "e", ["id"], "n")
    spells = labelled.groupBy("n").agg(F.min("s"), F.max("e"), F.count("*"))
    assert {tuple(r) for r in spells.collect()} == expected


def test_scd2_windows(spark):
    rows = [(1, f"2025-01-0{d}", f"k{d}") for d in (9, 1, 5)] + [(2, "2025-01-03", "k0")]
    df = spark.createDataFrame(rows, "sub int, at string, key string").withColumn(
        "at", F.to_timestamp_ntz("at", F.lit("yyyy-MM-dd"))
    )
    for groups in (None, find_hot_groups(df, ["sub"], 2)):
        result = scd2_windows(df, "sub", "at", "key", "2999-12-31 23:59:59", groups)
        got = {
            (r["sub"], r["valid_from"].day, (r["valid_to"].year, r["valid_to"].day), r["is_current_state"])
            for r in result.collect()
        }
        assert got == {
            (1, 1, (2025, 5), False),
            (1, 5, (2025, 9), False),
            (1, 9, (2999, 31), True),
            (2, 3, (2999, 31), True),
        }


def test_hot_keys_of_all_columns_at_once(spark, monkeypatch):
    """One pass for several keys and types; sampled or not, the same groups with exact sizes."""
    rows = [("a" if i % 3 == 0 else f"k{i % 700}", "7" if i % 5 == 0 else f"0{i % 9}" if i % 7 else None) for i in range(6000)]
    df = spark.createDataFrame(rows, "x string, y string")
    keys = {"x": ("x", "string"), "y": ("y", "string"), "n": ("y", "bigint"), "none": ("x", "bigint")}
    counts = {name: Counter(r[c == "y"] and (r[c == "y"] if t == "string" else int(r[c == "y"]) if (r[c == "y"] or "").isdigit() else None)
                            for r in rows) for name, (c, t) in keys.items()}
    for sampled in (10_000, 64):
        monkeypatch.setattr(split_window, "SAMPLED", sampled)
        found = split_window.find_hot_keys(df, keys, 900)
        for name, (column, _) in keys.items():
            want = {k for k, n in counts[name].items() if n > 900}
            assert ({r[column] for r in found[name].keys.collect()} if found[name] else set()) == want
            if want:
                total = sum(n for n in counts[name].values() if n > 900)
                assert found[name].pieces == max(2, -(-2 * total // 900))
    assert split_window.find_hot_keys(df, {"x": ("x", "string")}, 5000) == {"x": None}


@pytest.mark.parametrize("limit", [6, 1000])
def test_containing_pairs(spark, limit):
    """Counts of containment equal trying all pairs; hot keys and hot blocks are cut alike."""
    draw = random.Random(14)
    outer = [(draw.choice("aab"), i, lo := draw.randrange(40), lo + draw.randrange(1, 30)) for i in range(90)] + [("z", 1, 0, 99)]
    inner = [(draw.choice("aabc"), 1000 + i, lo := draw.randrange(40), lo + draw.randrange(8)) for i in range(60)]
    want = Counter()
    for k, _, a, b in inner:
        want[k] += sum(1 for j, _, c, d in outer if j == k and c < a and b < d)
    schema = "k string, id int, lo int, hi int"
    left, right = spark.createDataFrame(outer, schema), spark.createDataFrame(inner, schema)
    hot = find_hot_groups(left.unionByName(right), ["k"], limit)
    assert (hot is not None) == (limit == 6)
    got = containing_pairs(left, right, "k", "id", ("lo", "hi"), ("lo", "hi"), hot)
    assert {r["k"]: r["pairs"] for r in got.collect()} == dict(want)
    assert containing_pairs(left, right.limit(0), "k", "id", ("lo", "hi"), ("lo", "hi")).count() == 0
