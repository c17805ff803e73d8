"""Time the headline queries and print one JSON line.

Each query writes its full result to a noop sink: one warm-up, then the median of the runs. The
raw layer is landed before; landing is timed as a query of its own (to fresh folders, like the
others), and so is the whole build, which writes every mart. With BENCH_SQL=1 the SQL twins run in
DuckDB on the same tables for comparison, from the driver tables each time. BENCH_QUERIES names a
comma-separated part of the queries.
"""

from __future__ import annotations

import itertools
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyreel import catalog, standard_config  # noqa: E402
from tallyreel.plans.build import build  # noqa: E402
from tallyreel.session import get_session  # noqa: E402
from tallyreel.sources.raw import land_raw  # noqa: E402
from tallyreel.sources.sample_feed import mapped_tables  # noqa: E402
from tallyreel.sources.workspace import shared_folder  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINES = [
    "stg_playback_events",
    "stg_subscriptions",
    "dim_asset",
    "dim_subscription_history",
    "fct_user_paid_spells",
    "fct_session",
    "dim_user",
    "fct_session_engagement",
    "fct_user_engagement",
    "checks_source",
    "checks_staging",
    "checks_marts_data",
    "checks_marts_product",
    "assert_spine_grain",
    "profile_key_uniqueness",
    "profile_overlapping_subs",
    "profile_heartbeat_cadence",
    "profile_session_quantiles",
    "profile_stop_by_type",
    "profile_clock_vs_playhead",
    "profile_grain_comparison",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def sql_seconds(name: str) -> float:
    from pathlib import Path

    import duckdb

    from tallyreel.oracle.statements import statements

    con = duckdb.connect(config={"threads": int(CPUS)})
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    statement = f"CREATE OR REPLACE TEMP TABLE result AS {statements()[name]}"
    con.execute(statement)
    return statistics.median(timed(lambda: con.execute(statement)) for _ in range(RUNS))


def main() -> None:
    spark = get_session(
        "tallyreel-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tallyreel-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    raw = catalog.landed_sample(spark, SF_DIR)
    folders = (f"{shared_folder(spark)}/bench-{i}" for i in itertools.count())
    actions = {
        "land_raw": lambda: land_raw(mapped_tables(spark, SF_DIR), next(folders)),
        "build_all_marts": lambda: build(raw, standard_config(), next(folders)),
    }
    for name in HEADLINES:
        actions[name] = lambda name=name: (
            catalog.run(name, spark, SF_DIR).write.format("noop").mode("overwrite").save()
        )
    wanted = os.environ.get("BENCH_QUERIES")
    if wanted:
        actions = {name: actions[name] for name in wanted.split(",")}
    seconds = {}
    for name, action in actions.items():
        action()
        seconds[name] = statistics.median(timed(action) for _ in range(RUNS))
    rounded = {k: round(v, 3) for k, v in seconds.items()}
    result = {
        "metric": "sum of median seconds over headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": rounded,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }
    if os.environ.get("BENCH_SQL"):
        result["sql_twin"] = {name: round(sql_seconds(name), 3) for name in HEADLINES if name in seconds}
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
