"""One SQL statement per registered query."""

from __future__ import annotations

from tallyreel.oracle.tables import encoding, naive_time, row_key, values, with_tables
from tallyreel.plans.descriptions import COLUMNS
from tallyreel.plans.marts_data import ENDED_STATES, PAID_PLANS
from tallyreel.quality import declared as D
from tallyreel.sources.raw import RAW_COLUMNS

# The sample feed's own channels, as in the catalog of queries.
_CHANNELS = ["automobile", "building", "furniture", "household", "machinery"]

_SQL_NAMES = {
    "raw_playback_events": "raw_events",
    "raw_subscriptions": "raw_subs",
    "raw_asset_catalog": "raw_catalog",
    "fx_rates": "rates",
}
_RAW_NAMES = {
    "playback_events": "raw_events",
    "subscriptions": "raw_subs",
    "asset_catalog": "raw_catalog",
    "users": "raw_users",
}

BODIES: dict[str, str] = {}


def _literal(value: object) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# ------------------------------------------------------------------ sources and sinks
BODIES["read_raw_csv"] = r"""SELECT * REPLACE (
    'The "' || title || '",' || CASE WHEN sport = 'FB' THEN chr(13) || chr(10) WHEN asset_type = 'LIVE' THEN chr(10) ELSE ' ' END
    || 'part 1\' AS title) FROM raw_catalog"""
BODIES["landing_report"] = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, count(*) AS row_count, {len(RAW_COLUMNS[table])} AS column_count "
    f"FROM {name}"
    for table, name in _RAW_NAMES.items()
)
BODIES["land_raw"] = BODIES["landing_report"]
BODIES["load_seed"] = """
SELECT currency, rate_to_usd, valid_from, valid_to,
       (SELECT count(*) FROM raw_subs s WHERE s.currency = rates.currency) AS subscription_rows
FROM rates"""
BODIES["staging_view"] = "SELECT home_state, count(*) AS users FROM stg_users GROUP BY home_state"
BODIES["write_mart"] = "SELECT * FROM dim_asset"
BODIES["persist_docs"] = " UNION ALL ".join(
    f"SELECT '{column}' AS col_name, {_text(text)} AS comment, count({column}) AS filled FROM dim_asset"
    for column, text in COLUMNS["dim_asset"].items()
)
BODIES["project_vars"] = """
SELECT count(*) FILTER (completion_pct >= 0.30::double) AS at_or_above_engaged,
       count(*) FILTER (completion_pct >= 0.10::double) AS at_or_above_sampled,
       (SELECT count(*) FROM dim_subscription_history WHERE valid_to = timestamp '2999-12-31 23:59:59')
           AS open_windows
FROM fct_session"""

# ------------------------------------------------------------------ cleaning expressions
BODIES["normalize_timestamp"] = f"SELECT event_id, {naive_time('event_ts')} AS event_at_utc FROM raw_events"
BODIES["timestamp_source_format"] = (
    f"SELECT event_id, {encoding('event_ts')} AS event_ts_source_format FROM raw_events"
)
BODIES["surrogate_key"] = (
    f"SELECT event_id, {row_key('session_id', 'user_id', 'event_ts')} AS row_key FROM raw_events"
)
BODIES["map_category_sport"] = "SELECT asset_id::varchar AS asset_id, sport FROM stg_asset_catalog"
BODIES["map_category_state"] = "SELECT user_id::varchar AS user_id, home_state FROM stg_users"
BODIES["null_out_invalid"] = """
SELECT asset_id::varchar AS asset_id, duration_seconds, duration_seconds_raw, has_invalid_duration
FROM stg_asset_catalog"""
BODIES["replay_flag"] = "SELECT asset_id, title, suffix(trim(title), '(Replay)') AS is_replay FROM raw_catalog"
BODIES["keep_raw_copy"] = "SELECT user_id, home_state, home_state_raw FROM stg_users"
BODIES["typed_cast"] = """
SELECT event_id::bigint AS event_id, position_seconds::double AS position_seconds,
       bitrate_kbps::int AS bitrate_kbps, try_cast(session_id AS bigint) AS session_number
FROM raw_events"""
BODIES["anonymous_flag"] = "SELECT event_id, user_id IS NULL AS is_anonymous_view FROM raw_events"

# ------------------------------------------------------------------ staging and marts
for _table in (
    "stg_playback_events",
    "stg_asset_catalog",
    "stg_subscriptions",
    "stg_users",
    "dim_asset",
    "dim_subscription_history",
    "fct_user_paid_spells",
    "fct_session",
    "dim_user",
    "fct_session_engagement",
):
    BODIES[_table] = f"SELECT * FROM {_table}"
BODIES["fct_user_engagement"] = """
SELECT * REPLACE (round(avg_completion_pct, 9) AS avg_completion_pct) FROM fct_user_engagement"""
BODIES["classified_sessions"] = """
SELECT session_id, f.user_id, watch_minutes, f.completion_pct, is_engaged_view
FROM fct_session f JOIN fct_session_engagement g USING (session_id)"""
BODIES["user_measures"] = """
SELECT user_id, count(*) AS session_count, count(*) FILTER (is_engaged_view) AS engaged_session_count,
       count(DISTINCT asset_id) AS distinct_assets_watched, sum(watch_minutes)::bigint AS total_watch_minutes,
       sum(if(is_engaged_view, watch_minutes, 0))::bigint AS engaged_watch_minutes,
       max(completion_pct) AS best_completion_pct, round(avg(completion_pct), 9) AS avg_completion_pct,
       min(session_start_at_utc) AS first_session_at, max(session_end_at_utc) AS last_session_at,
       count(DISTINCT session_start_at_utc::date) AS active_days,
       count(DISTINCT sport) AS distinct_sports_watched
FROM (SELECT *, completion_pct >= 0.30::double AS is_engaged_view FROM fct_session)
WHERE user_id IS NOT NULL GROUP BY user_id"""
BODIES["dedupe_first"] = """
SELECT DISTINCT ON (event_id) * FROM raw_events ORDER BY event_id, session_id, event_ts, position_seconds"""
BODIES["collapse_agreeing"] = """
SELECT sport, max(home_school) AS home_school, max(away_school) AS away_school,
       max(scheduled_start_ts) AS scheduled_start_ts, count(*) AS source_row_count,
       count(*) > 1 AS has_ambiguous_identity
FROM raw_catalog GROUP BY sport"""
BODIES["scd2_windows"] = """
SELECT subscription_change_key, subscription_id, status, effective_at_utc, effective_at_utc AS valid_from,
       coalesce(following, timestamp '2999-12-31 23:59:59') AS valid_to, following IS NULL AS is_current_state
FROM (SELECT *, lead(effective_at_utc) OVER (PARTITION BY subscription_id
                                             ORDER BY effective_at_utc, subscription_change_key) AS following
      FROM stg_subscriptions)"""
BODIES["merge_intervals"] = """
SELECT user_id, stretch, min(valid_from) AS valid_from, max(valid_to) AS valid_to, count(*) AS windows
FROM (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY valid_from, valid_to, subscription_change_key
                                 ROWS UNBOUNDED PRECEDING)::bigint AS stretch
      FROM (SELECT *, if(valid_from <= max(valid_to) OVER (
                             PARTITION BY user_id ORDER BY valid_from, valid_to, subscription_change_key
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0, 1) AS opens
            FROM dim_subscription_history WHERE status NOT IN ('canceled', 'expired')))
GROUP BY user_id, stretch"""
BODIES["sessionize"] = "SELECT * FROM session_totals"
BODIES["classify_threshold"] = """
SELECT session_id, if(buffers_per_10min < 0.5::double, 'smooth',
                      if(buffers_per_10min < 1.5::double, 'uneven', 'rough')) AS playback_quality
FROM fct_session"""
BODIES["spine_rollup"] = """
SELECT u.user_id, count(s.subscription_id) AS changes, max(effective_at_utc) AS last_change_at
FROM stg_users u LEFT JOIN stg_subscriptions s ON s.user_id = u.user_id GROUP BY u.user_id"""
BODIES["temporal_rate_join"] = """
SELECT subscription_change_key, s.currency, effective_at_utc::date AS on_date, rate_to_usd
FROM stg_subscriptions s
LEFT JOIN rates r ON r.currency = s.currency
  AND effective_at_utc::date >= r.valid_from AND effective_at_utc::date <= r.valid_to"""
BODIES["temporal_rate_join_daily"] = """
SELECT subscription_change_key, s.currency, s.on_date, r.rate_to_usd, r.valid_to
FROM (SELECT subscription_change_key, currency, effective_at_utc::date AS on_date FROM stg_subscriptions) s
LEFT JOIN (
    SELECT DISTINCT currency, effective_at_utc::date AS valid_from, effective_at_utc::date AS valid_to,
           ((effective_at_utc::date - date '1970-01-01') % 100 + 1)::double AS rate_to_usd
    FROM stg_subscriptions WHERE currency IS NOT NULL AND effective_at_utc IS NOT NULL
    UNION ALL
    SELECT DISTINCT currency, date_trunc('month', effective_at_utc)::date, last_day(effective_at_utc), 0.5::double
    FROM stg_subscriptions WHERE currency IS NOT NULL AND effective_at_utc IS NOT NULL) r
  ON r.currency = s.currency AND s.on_date BETWEEN r.valid_from AND r.valid_to"""
BODIES["orphan_filter_join"] = """
SELECT subscription_change_key, user_id FROM stg_subscriptions
WHERE user_id IN (SELECT user_id FROM stg_users)"""


# ------------------------------------------------------------------ declared checks
def _declared(suite: list[D.Declared]) -> str:
    parts = []

    def add(name: str, failing: str) -> None:
        parts.append(f"SELECT {_text(name)} AS check_name, count(*) AS failing_rows FROM ({failing})")

    for d in suite:
        t = _SQL_NAMES.get(d.table, d.table)
        for c in d.not_null:
            add(f"{d.table}.{c}: not_null", f"SELECT 1 FROM {t} WHERE {c} IS NULL")
        for c, values in d.accepted.items():
            listed = ", ".join(_literal(v) for v in values)
            add(f"{d.table}.{c}: accepted_values", f"SELECT 1 FROM {t} WHERE {c} NOT IN ({listed})")
        for i, e in enumerate(d.expressions, 1):
            e = e.replace("timestamp_ntz", "timestamp ")
            add(f"{d.table}: expression {i}", f"SELECT 1 FROM {t} WHERE NOT ({e})")
        for c in d.unique:
            add(
                f"{d.table}.{c}: unique",
                f"SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1",
            )
        for columns in d.unique_together:
            listed = ", ".join(columns)
            add(
                f"{d.table}.({listed}): unique_combination",
                f"SELECT {listed} FROM {t} GROUP BY {listed} HAVING count(*) > 1",
            )
        for column, parent, parent_column in d.relationships:
            p = _SQL_NAMES.get(parent, parent)
            add(
                f"{d.table}.{column}: relationships {parent}",
                f"SELECT 1 FROM {t} c WHERE {column} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {p} p WHERE p.{parent_column} = c.{column})",
            )
    return " UNION ALL ".join(parts)


BODIES["checks_source"] = _declared(D.source_checks(_CHANNELS))
BODIES["checks_staging"] = _declared(D.STAGING_CHECKS)
BODIES["checks_marts_data"] = _declared(D.DATA_CHECKS)
BODIES["checks_marts_product"] = _declared(D.PRODUCT_CHECKS)
BODIES["checks_seed"] = (
    _declared(D.SEED_CHECKS)
    + """ UNION ALL SELECT 'stg_subscriptions: no rate', count(*) FROM stg_subscriptions
WHERE usd_billing_period_amount IS NULL"""
)

BODIES["check_not_null"] = "SELECT event_id, session_id FROM raw_events WHERE user_id IS NULL"
BODIES["check_unique"] = """
SELECT event_id, count(*) AS n_records FROM raw_events GROUP BY event_id HAVING count(*) > 1"""
BODIES["check_accepted_values"] = (
    "SELECT asset_id, title, sport FROM raw_catalog WHERE sport NOT IN ("
    + ", ".join(_literal(s) for s in D.SPORT_NAMES)
    + ")"
)
BODIES["check_relationships"] = """
SELECT event_id, asset_id FROM raw_events e
WHERE asset_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM raw_catalog c WHERE c.asset_id = e.asset_id)"""
BODIES["check_unique_combination"] = """
SELECT asset_id, sport, count(*) AS n_records FROM raw_catalog GROUP BY asset_id, sport HAVING count(*) > 1"""
BODIES["check_expression"] = "SELECT user_id, home_state FROM raw_users WHERE NOT (length(home_state) = 2)"


def _failing(name: str, query: str) -> None:
    BODIES[name] = f"SELECT '{name}' AS check_name, count(*) AS failing_rows FROM ({query})"


_failing(
    "assert_collapse_columns_agree",
    """SELECT a.asset_id FROM stg_asset_catalog a JOIN stg_asset_catalog b ON a.asset_id = b.asset_id
       WHERE a.sport <> b.sport OR a.home_school <> b.home_school OR a.away_school <> b.away_school
          OR a.scheduled_start_at_utc <> b.scheduled_start_at_utc
          OR coalesce(a.duration_seconds, -1) <> coalesce(b.duration_seconds, -1)
       GROUP BY a.asset_id""",
)
_failing(
    "assert_duplicates_identical",
    """SELECT event_id FROM (SELECT DISTINCT * FROM raw_events) GROUP BY event_id HAVING count(*) > 1""",
)
_failing(
    "assert_row_reconciliation",
    """SELECT 1 WHERE (SELECT count(*) FROM raw_events) - (SELECT count(*) FROM stg_playback_events)
         IS DISTINCT FROM (SELECT count(*) - count(DISTINCT event_id) FROM raw_events)""",
)
_failing(
    "assert_rowcount_equal",
    """SELECT 1 WHERE (SELECT count(*) FROM raw_catalog) <> (SELECT count(*) FROM stg_asset_catalog)
       UNION ALL
       SELECT 1 WHERE (SELECT count(*) FROM raw_users) <> (SELECT count(*) FROM stg_users)
       UNION ALL
       SELECT 1 WHERE (SELECT count(*) FROM raw_subs) <> (SELECT count(*) FROM stg_subscriptions)""",
)
_failing(
    "assert_exclusions_reconcile",
    """SELECT 1 WHERE (SELECT count(DISTINCT session_id) FROM stg_playback_events)
                     - (SELECT count(*) FROM fct_session)
         IS DISTINCT FROM (SELECT count(DISTINCT session_id) FROM stg_playback_events e
                           WHERE NOT EXISTS (SELECT 1 FROM dim_asset a WHERE a.asset_id = e.asset_id
                                             AND a.duration_seconds IS NOT NULL))""",
)
_failing(
    "assert_windows_contiguous",
    """SELECT 1 FROM (SELECT valid_to, lead(valid_from) OVER (
                              PARTITION BY subscription_id
                              ORDER BY valid_from, subscription_change_key) AS following
                      FROM dim_subscription_history)
       WHERE following IS NOT NULL AND valid_to IS DISTINCT FROM following""",
)
_failing(
    "assert_intervals_no_overlap",
    """SELECT b.user_id FROM fct_user_paid_spells a JOIN fct_user_paid_spells b
         ON a.user_id = b.user_id AND a.spell_number < b.spell_number
        AND a.paid_from < b.paid_to AND b.paid_from < a.paid_to""",
)
_failing(
    "assert_spine_grain",
    """SELECT 1 FROM (SELECT count(*) AS n, count(DISTINCT user_id) AS u, sum(session_count) AS s
                      FROM fct_user_engagement)
       WHERE n IS DISTINCT FROM (SELECT count(*) FROM stg_users)
          OR u IS DISTINCT FROM (SELECT count(*) FROM stg_users)
          OR s IS DISTINCT FROM (SELECT count(*) FROM fct_session
                                 WHERE user_id IS NOT NULL AND NOT has_unknown_user)""",
)
BODIES["intervals_before_merge"] = """
SELECT subscription_change_key, user_id, valid_from, furthest_end
FROM (SELECT *, max(valid_to) OVER (PARTITION BY user_id
                                    ORDER BY valid_from, valid_to, subscription_change_key
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS furthest_end
      FROM dim_subscription_history WHERE is_paid_plan AND is_active_state)
WHERE valid_from < furthest_end"""

# ------------------------------------------------------------------ profiles of raw text
BODIES["profile_key_uniqueness"] = " UNION ALL ".join(
    f"SELECT '{label}' AS key, count(*) AS rows, count(DISTINCT {what}) AS distinct_vals, "
    f"count(*) - count(DISTINCT {what}) AS surplus_rows FROM {table}"
    for label, table, what in [
        ("playback_events.event_id", "raw_events", "event_id"),
        ("users.user_id", "raw_users", "user_id"),
        ("asset_catalog.asset_id", "raw_catalog", "asset_id"),
        ("subscriptions.subscription_id", "raw_subs", "subscription_id"),
        ("subscriptions.(sub_id, eff_ts)", "raw_subs", "(subscription_id, event_effective_ts)"),
    ]
)


def _share(counts: str, count: str, digits: int) -> str:
    return f"SELECT *, round(100.0::double * {count} / sum({count}) OVER (), {digits}) AS pct FROM ({counts})"


BODIES["profile_string_shapes"] = _share(
    r"""SELECT case when event_ts IS NULL then '1. NULL' when event_ts = '' then '2. empty string'
               when regexp_full_match(event_ts, '\d+') then '3. epoch digits'
               when regexp_full_match(event_ts, '\d{4}-\d{2}-\d{2}T.*Z') then '4. ISO-8601 Z'
               when regexp_full_match(event_ts, '\d{4}-\d{2}-\d{2}T.*') then '5. ISO no Z'
               when regexp_full_match(event_ts, '\d{4}-\d{2}-\d{2} .*') then '6. ISO space sep'
               else '7. OTHER' end AS ts_shape,
          count(*) AS rows, min(event_ts) AS min_example, max(event_ts) AS max_example
        FROM raw_events GROUP BY 1""",
    "rows",
    2,
)
BODIES["profile_nulls_blanks"] = " UNION ALL ".join(
    f"SELECT '{c}' AS col, count(*) FILTER ({c} IS NULL) AS nulls, count(*) FILTER ({c} = '') AS blanks, "
    f"round(100.0::double * count(*) FILTER ({c} IS NULL OR {c} = '') / count(*), 2) AS pct_missing "
    f"FROM raw_events"
    for c in RAW_COLUMNS["playback_events"]
    if c != "event_id"
)
BODIES["profile_categorical"] = " UNION ALL ".join(
    f"(SELECT '{table}.{c}' AS col, {c} AS value, count(*) AS rows FROM {_RAW_NAMES[table]} "
    f"GROUP BY {c} ORDER BY rows DESC, value NULLS LAST LIMIT 40)"
    for table, c in [
        ("playback_events", "event_type"),
        ("playback_events", "device_type"),
        ("playback_events", "app_version"),
        ("asset_catalog", "asset_type"),
        ("asset_catalog", "sport"),
        ("subscriptions", "status"),
        ("subscriptions", "plan_type"),
        ("subscriptions", "currency"),
        ("users", "acquisition_channel"),
    ]
)
BODIES["profile_code_oddities"] = """
SELECT count(DISTINCT home_state) AS distinct_states,
       count(*) FILTER (length(home_state) <> 2) AS not_two_chars,
       count(*) FILTER (home_state <> upper(home_state)) AS not_upper,
       count(*) FILTER (home_state IS NULL OR home_state = '') AS missing
FROM raw_users"""
BODIES["profile_fk_orphans_leftjoin"] = """
SELECT 'playback_events.asset_id -> asset_catalog' AS fk, count(*) AS child_rows,
       count(*) - count(p.asset_id) AS orphans
FROM raw_events c LEFT JOIN raw_catalog p ON p.asset_id = c.asset_id
UNION ALL
SELECT 'playback_events.user_id -> users (non-blank only)', count(*), count(*) - count(p.user_id)
FROM raw_events c LEFT JOIN raw_users p ON p.user_id = c.user_id
WHERE c.user_id IS NOT NULL AND c.user_id <> ''
UNION ALL
SELECT 'subscriptions.user_id -> users', count(*), count(*) - count(p.user_id)
FROM raw_subs c LEFT JOIN raw_users p ON p.user_id = c.user_id"""
BODIES["profile_fk_orphans_antijoin"] = " UNION ALL ".join(
    f"SELECT '{label}' AS fk, count(*) AS orphan_rows, count(DISTINCT {key}) AS orphan_keys FROM {child} c "
    f"WHERE {key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{key})"
    for label, child, parent, key in [
        ("events -> asset_catalog", "raw_events", "raw_catalog", "asset_id"),
        ("events -> users (non-null only)", "raw_events", "raw_users", "user_id"),
        ("subscriptions -> users", "raw_subs", "raw_users", "user_id"),
    ]
)
BODIES["profile_numeric_sanity"] = " UNION ALL ".join(
    f"SELECT '{label}.{c}' AS col, count(*) FILTER (NOT regexp_full_match({c}, '-?[0-9.]+')) AS non_numeric, "
    f"count(*) FILTER (try_cast({c} AS double) < 0) AS negative, min(try_cast({c} AS double)) AS min_val, "
    f"max(try_cast({c} AS double)) AS max_val FROM {_RAW_NAMES[label]}"
    for label, c in [
        ("playback_events", "position_seconds"),
        ("playback_events", "bitrate_kbps"),
        ("asset_catalog", "duration_seconds"),
        ("subscriptions", "mrr_amount"),
    ]
)
BODIES["profile_session_volume"] = """
SELECT count(DISTINCT session_id) AS sessions, count(*) AS events,
       round(count(*)::double / count(DISTINCT session_id), 2) AS events_per_session,
       count(DISTINCT user_id) AS distinct_users, count(DISTINCT asset_id) AS distinct_assets
FROM raw_events"""
BODIES["profile_session_invariants"] = """
SELECT count(*) FILTER (a > 1) AS sessions_multi_asset, count(*) FILTER (u > 1) AS sessions_multi_user,
       count(*) AS total_sessions
FROM (SELECT count(DISTINCT asset_id) AS a, count(DISTINCT user_id) AS u FROM raw_events GROUP BY session_id)"""
BODIES["profile_session_composition"] = """
SELECT has_play, has_stop, count(*) AS sessions
FROM (SELECT bool_or(event_type = 'play')::int AS has_play, bool_or(event_type = 'stop')::int AS has_stop
      FROM raw_events GROUP BY session_id)
GROUP BY has_play, has_stop"""
BODIES["profile_rows_per_entity"] = """
SELECT 'rows per subscription_id' AS metric, min(n) AS "min", max(n) AS "max", round(avg(n), 2) AS "avg",
       count(*) AS n_entities
FROM (SELECT count(*) AS n FROM raw_subs GROUP BY subscription_id)
UNION ALL
SELECT 'subscriptions per user_id', min(n), max(n), round(avg(n), 2), count(*)
FROM (SELECT count(DISTINCT subscription_id) AS n FROM raw_subs GROUP BY user_id)"""
BODIES["profile_status_plan_matrix"] = """
SELECT status, plan_type, count(*) AS rows, count(DISTINCT mrr_amount) AS distinct_mrr,
       min(mrr_amount) AS min_mrr, max(mrr_amount) AS max_mrr
FROM raw_subs GROUP BY status, plan_type"""
BODIES["profile_coverage"] = """
SELECT (SELECT count(*) FROM raw_users) AS users_total,
       (SELECT count(DISTINCT user_id) FROM raw_subs) AS users_with_sub,
       (SELECT count(DISTINCT user_id) FROM raw_events WHERE user_id <> '') AS users_with_playback"""
_FANOUT = """
SELECT (SELECT count(*) FROM raw_events) AS {0},
       (SELECT count(*) FROM raw_events JOIN raw_catalog USING (asset_id)) AS {1},
       (SELECT count(*) FROM raw_events LEFT JOIN raw_catalog USING (asset_id)) AS {2}"""
BODIES["profile_fanout"] = _FANOUT.format(
    "events_before", "events_after_inner_join", "events_after_left_join"
)
BODIES["profile_duplicate_key_shape"] = """
SELECT asset_id, count(*) AS n_rows, count(DISTINCT title) AS n_titles, count(DISTINCT asset_type) AS n_types,
       count(DISTINCT sport) AS n_sports, count(DISTINCT duration_seconds) AS n_durations,
       count(DISTINCT (title, asset_type, sport, home_school, away_school, scheduled_start_ts,
                       duration_seconds)) AS n_distinct_full_rows
FROM raw_catalog GROUP BY asset_id HAVING count(*) > 1"""
BODIES["profile_duplicate_identity"] = """
SELECT n AS n_rows_per_id, count(*) AS n_event_ids, count(*) FILTER (v = 1) AS ids_with_identical_rows,
       count(*) FILTER (v > 1) AS ids_with_conflicting_rows
FROM (SELECT event_id, sum(k)::bigint AS n, count(*) AS v
      FROM (SELECT *, count(*) AS k FROM raw_events GROUP BY ALL) GROUP BY event_id)
WHERE n > 1 GROUP BY n"""
_ENCODED = """count(*) FILTER (regexp_full_match({0}, '[0-9]+')) AS epoch,
       count(*) FILTER ({0} LIKE '%T%Z') AS iso_z, count(*) FILTER (contains({0}, ' ')) AS iso_space"""
for _dimension in ("app_version", "device_type"):
    BODIES[f"profile_encoding_by_{_dimension}"] = (
        f"SELECT {_dimension}, {_ENCODED.format('event_ts')} FROM raw_events GROUP BY {_dimension}"
    )
BODIES["profile_encoding_period"] = f"""
SELECT shape, count(*) AS rows, min(instant) AS min_ts, max(instant) AS max_ts
FROM (SELECT if(regexp_full_match(event_ts, '[0-9]+'), 'epoch',
                if(event_ts LIKE '%T%Z', 'iso_z', 'iso_space')) AS shape,
             {naive_time('event_ts')} AS instant
      FROM raw_events) GROUP BY shape"""
BODIES["profile_null_pattern"] = """
SELECT case when known = n then 'no nulls' when known = 0 then 'entire session anonymous'
            else 'MIXED within session' end AS pattern,
       count(*) AS sessions, sum(n)::bigint AS events
FROM (SELECT count(*) AS n, count(user_id) AS known FROM raw_events GROUP BY session_id) GROUP BY 1"""
BODIES["profile_bad_durations"] = """
SELECT asset_id, asset_type, sport, duration_seconds FROM raw_catalog
WHERE duration_seconds IS NULL OR try_cast(duration_seconds AS double) <= 0"""
_RUNTIMES = """(SELECT DISTINCT ON (asset_id) asset_id, asset_type, try_cast(duration_seconds AS double) AS dur
  FROM raw_catalog ORDER BY asset_id, title, asset_type, sport, home_school, away_school,
                            scheduled_start_ts, duration_seconds)"""
_POS = "try_cast(position_seconds AS double)"
BODIES["profile_position_vs_duration"] = f"""
SELECT count(*) AS events_checked, count(*) FILTER ({_POS} > dur) AS pos_beyond_duration,
       count(*) FILTER ({_POS} > dur * 1.05::double) AS pos_beyond_duration_5pct,
       round(max({_POS} / dur), 3) AS max_ratio
FROM raw_events JOIN {_RUNTIMES} r USING (asset_id) WHERE dur > 0"""
BODIES["profile_currency"] = """
SELECT currency, plan_type, count(*) AS rows, count(DISTINCT mrr_amount) AS distinct_amounts,
       min(mrr_amount) AS min_amt, max(mrr_amount) AS max_amt
FROM raw_subs GROUP BY currency, plan_type"""
_GAPS = f"""SELECT session_id, {_POS} - lag({_POS}) OVER (PARTITION BY session_id ORDER BY {_POS}, event_id)
         AS gap_seconds
  FROM raw_events WHERE event_type = 'heartbeat'"""
BODIES["heartbeat_gap_counts"] = f"""
SELECT gap_seconds, count(*) AS occurrences FROM ({_GAPS}) WHERE gap_seconds IS NOT NULL GROUP BY gap_seconds"""
BODIES["profile_heartbeat_cadence"] = (
    BODIES["heartbeat_gap_counts"] + " ORDER BY occurrences DESC, gap_seconds LIMIT 15"
)


def _quantiles(metrics: list[tuple[str, str]], source: str, fractions: list[float]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS metric, {float(q)}::double AS quantile, "
        f"quantile_cont({column}::double, {q}) AS value FROM ({source})"
        for label, column in metrics
        for q in fractions
    )


BODIES["profile_session_quantiles"] = _quantiles(
    [("heartbeats_pctiles", "beats"), ("max_position_pctiles", "furthest")],
    f"SELECT count(*) FILTER (event_type = 'heartbeat') AS beats, max({_POS}) AS furthest "
    "FROM raw_events GROUP BY session_id",
    [0, 0.1, 0.25, 0.5, 0.75, 0.9, 1],
)
_COMPLETION = f"""SELECT session_id, max({_POS}) / max(dur) AS ratio
  FROM raw_events JOIN {_RUNTIMES} r USING (asset_id) GROUP BY session_id HAVING max(dur) > 0"""
BODIES["profile_completion_histogram"] = f"""
SELECT round(least(floor(ratio * 10) / 10, 1), 1) AS completion_bucket, count(*) AS sessions
FROM ({_COMPLETION}) GROUP BY 1"""
BODIES["completion_deciles"] = f"""
SELECT round(floor(least(ratio, 1) * 10) / 10, 1) AS completion_bucket, count(*) AS sessions
FROM ({_COMPLETION}) GROUP BY 1"""
BODIES["profile_ts_formats"] = " UNION ALL ".join(
    f"SELECT '{table}.{c}' AS col, {_ENCODED.format(c)}, count(*) FILTER ({c} IS NULL OR {c} = '') AS missing "
    f"FROM {_RAW_NAMES[table]}"
    for table, c in [
        ("subscriptions", "event_effective_ts"),
        ("users", "signup_ts"),
        ("asset_catalog", "scheduled_start_ts"),
    ]
)
BODIES["profile_subs_per_user"] = """
SELECT n AS subscriptions_held, count(*) AS users
FROM (SELECT count(DISTINCT subscription_id) AS n FROM raw_subs GROUP BY user_id) GROUP BY n"""
_SPANS = """(SELECT user_id, subscription_id, min(try_cast(event_effective_ts AS timestamp)) AS first_ts,
        max(try_cast(event_effective_ts AS timestamp)) AS last_ts
  FROM raw_subs GROUP BY user_id, subscription_id)"""
_PAIRED = """a.user_id = b.user_id AND a.subscription_id < b.subscription_id
 AND a.first_ts <= b.last_ts AND b.first_ts <= a.last_ts"""
BODIES["profile_overlapping_subs"] = f"""
SELECT count(*) AS overlapping_pairs, count(DISTINCT a.user_id) AS users_with_overlap
FROM {_SPANS} a JOIN {_SPANS} b ON {_PAIRED}"""
BODIES["overlapping_pairs_list"] = f"""
SELECT a.user_id, a.subscription_id AS sub_a, b.subscription_id AS sub_b, a.first_ts AS a_from,
       a.last_ts AS a_to, b.first_ts AS b_from, b.last_ts AS b_to
FROM {_SPANS} a JOIN {_SPANS} b ON {_PAIRED}
ORDER BY a.user_id, greatest((a.first_ts, a.subscription_id), (b.first_ts, b.subscription_id)),
         least((a.first_ts, a.subscription_id), (b.first_ts, b.subscription_id))
LIMIT 50"""
BODIES["sample_subscription"] = """
SELECT * FROM raw_subs
WHERE subscription_id = (SELECT min(subscription_id) FROM (
    SELECT subscription_id FROM raw_subs GROUP BY subscription_id HAVING count(*) = 3))"""
BODIES["sample_multi_sub_user"] = """
SELECT * FROM raw_subs
WHERE user_id = (SELECT user_id FROM raw_subs GROUP BY user_id HAVING count(DISTINCT subscription_id) >= 4
                 ORDER BY count(*) DESC, user_id LIMIT 1)"""
BODIES["profile_status_paths"] = """
SELECT path, count(*) AS subscriptions
FROM (SELECT string_agg(status, ' -> ' ORDER BY event_effective_ts, status) AS path
      FROM raw_subs GROUP BY subscription_id) GROUP BY path"""
BODIES["subscription_lifecycles"] = BODIES["profile_status_paths"]
BODIES["profile_stops_per_session"] = """
SELECT n_stops, count(*) AS sessions
FROM (SELECT count(*) FILTER (event_type = 'stop') AS n_stops FROM raw_events GROUP BY session_id)
GROUP BY n_stops"""
_STOPS = f"""(SELECT session_id, dur, asset_type,
        max({_POS}) FILTER (event_type = 'stop') / dur AS ratio
  FROM raw_events JOIN {_RUNTIMES} r USING (asset_id) WHERE dur > 0
  GROUP BY session_id, dur, asset_type)"""
BODIES["profile_stop_vs_duration"] = _share(
    f"""SELECT case when ratio >= 0.98::double then 'a. >=98% of asset (natural end)'
               when ratio >= 0.90::double then 'b. 90-98%' when ratio >= 0.50::double then 'c. 50-90%'
               when ratio >= 0.10::double then 'd. 10-50%' else 'e. <10% (early abandon)' end AS stop_point,
          count(*) AS sessions
        FROM {_STOPS} WHERE ratio IS NOT NULL GROUP BY 1""",
    "sessions",
    1,
)
_LAST = f"""SELECT max({_POS}) FILTER (event_type = 'stop') AS stop_at,
       max({_POS}) FILTER (event_type = 'heartbeat') AS beat_at
  FROM raw_events GROUP BY session_id"""
BODIES["profile_stop_vs_heartbeat"] = f"""
SELECT case sign(stop_at - beat_at) when 0 then 'identical' when 1 then 'stop is later'
            when -1 then 'stop is EARLIER' else 'null somewhere' end AS relation,
       count(*) AS sessions, round(avg(stop_at - beat_at), 1) AS avg_gap_seconds
FROM ({_LAST}) GROUP BY 1"""
BODIES["stop_vs_last_beat"] = f"""
SELECT case sign(stop_at - beat_at) when 0 then 'identical' when 1 then 'stop later'
            else 'stop earlier' end AS relation,
       count(*) AS sessions, round(avg(stop_at - beat_at), 1) AS avg_gap_seconds
FROM ({_LAST}) GROUP BY 1"""
BODIES["profile_stop_by_type"] = f"""
SELECT asset_type, count(*) AS sessions, round(avg(ratio), 3) AS avg_completion_at_stop,
       round(quantile_cont(ratio, 0.5), 3) AS median_completion_at_stop,
       count(*) FILTER (ratio >= 0.98::double) AS reached_98pct
FROM {_STOPS} WHERE ratio IS NOT NULL GROUP BY asset_type"""
_PAIR_SESSIONS = """SELECT user_id, asset_id, count(DISTINCT session_id) AS n FROM raw_events
  WHERE user_id IS NOT NULL GROUP BY user_id, asset_id"""
BODIES["profile_sessions_per_user_asset"] = f"""
SELECT n AS sessions_on_asset, count(*) AS user_asset_pairs FROM ({_PAIR_SESSIONS}) GROUP BY n"""
BODIES["profile_rewatchers"] = f"""
SELECT count(DISTINCT user_id) AS users_with_playback,
       count(DISTINCT user_id) FILTER (n > 1) AS users_who_rewatch
FROM ({_PAIR_SESSIONS})"""


def _grain(label: str, source: str) -> str:
    return f"""SELECT '{label}' AS grain, count(*) AS units, round(avg(ratio), 4) AS avg_completion,
       count(*) FILTER (ratio > 0.2::double) AS above_0_2,
       round(100.0::double * count(*) FILTER (ratio > 0.2::double) / count(*), 1) AS pct_above_0_2
FROM ({source})"""


_BEST = f"FROM raw_events JOIN {_RUNTIMES} r USING (asset_id) WHERE dur > 0 AND user_id IS NOT NULL"
BODIES["profile_grain_comparison"] = (
    _grain("per session", f"SELECT max({_POS}) / max(dur) AS ratio {_BEST} GROUP BY user_id, asset_id, session_id")
    + " UNION ALL "
    + _grain("per (user, asset)", f"SELECT max({_POS}) / max(dur) AS ratio {_BEST} GROUP BY user_id, asset_id")
)
BODIES["profile_resume_or_restart"] = f"""
SELECT if(start_at <= 60, 'restarts near 0 (min_pos <= 60s)', 'starts later in the asset (resume-like)')
           AS second_session_behaviour,
       count(*) AS sessions
FROM (SELECT start_at, row_number() OVER (PARTITION BY user_id, asset_id ORDER BY start_at) AS turn
      FROM (SELECT user_id, asset_id, session_id, min({_POS}) AS start_at FROM raw_events
            WHERE user_id IS NOT NULL GROUP BY ALL))
WHERE turn > 1 GROUP BY 1"""
BODIES["profile_position_jumps"] = f"""
SELECT count(DISTINCT session_id) FILTER (gap_seconds > 60) AS sessions_with_a_jump,
       count(*) FILTER (gap_seconds > 60) AS jump_count, max(gap_seconds) AS largest_jump_seconds
FROM ({_GAPS})"""
BODIES["profile_pause"] = f"""
SELECT if(pauses = 0, 'no pause', 'has pause') AS pause_state, count(*) AS sessions,
       round(avg(furthest / dur), 3) AS avg_completion, count(*) FILTER (furthest > paused_at) AS resumed_past_pause
FROM (SELECT session_id, dur, count(*) FILTER (event_type = 'pause') AS pauses,
             max({_POS}) FILTER (event_type = 'pause') AS paused_at, max({_POS}) AS furthest
      FROM raw_events JOIN {_RUNTIMES} r USING (asset_id) WHERE dur > 0 GROUP BY session_id, dur)
GROUP BY 1"""
BODIES["profile_user_quantiles"] = _quantiles(
    [("sessions per user", "s"), ("assets per user", "a"), ("heartbeats (mins) per user", "h")],
    "SELECT count(DISTINCT session_id) AS s, count(DISTINCT asset_id) AS a, "
    "count(*) FILTER (event_type = 'heartbeat') AS h FROM raw_events WHERE user_id IS NOT NULL GROUP BY user_id",
    [0, 0.25, 0.5, 0.75, 0.9, 1],
)
BODIES["profile_whitespace"] = " UNION ALL ".join(
    f"SELECT '{table}.{c}' AS col, count(*) FILTER ({c} <> trim({c})) AS untrimmed FROM {_RAW_NAMES[table]}"
    for table, c in [
        ("asset_catalog", "sport"),
        ("asset_catalog", "home_school"),
        ("asset_catalog", "title"),
        ("users", "home_state"),
        ("users", "acquisition_channel"),
        ("playback_events", "device_type"),
        ("playback_events", "event_type"),
        ("subscriptions", "status"),
    ]
)
BODIES["profile_bad_codes"] = """
SELECT home_state, count(*) AS users FROM raw_users
WHERE length(home_state) <> 2 OR home_state <> upper(home_state) GROUP BY home_state"""
BODIES["profile_full_row_dupes"] = """
SELECT 'users' AS tbl, (SELECT count(*) FROM raw_users) - count(*) AS dupe_rows
FROM (SELECT DISTINCT * FROM raw_users)
UNION ALL
SELECT 'subscriptions', (SELECT count(*) FROM raw_subs) - count(*) FROM (SELECT DISTINCT * FROM raw_subs)"""

# ------------------------------------------------------------------ profiles of cleaned events
_ORDERED = "OVER (PARTITION BY session_id ORDER BY event_at_utc, position_seconds, event_id)"
BODIES["profile_sequence_sanity"] = f"""
SELECT count(*) AS transitions, count(*) FILTER (step < 0) AS position_goes_backwards,
       count(*) FILTER (step = 0) AS position_unchanged
FROM (SELECT position_seconds - lag(position_seconds) {_ORDERED} AS step FROM stg_playback_events)
WHERE step IS NOT NULL"""
_NEXT = f"""SELECT event_type, lead(event_type) {_ORDERED} AS next_type,
       lead(position_seconds) {_ORDERED} - position_seconds AS moved,
       date_diff('second', event_at_utc, lead(event_at_utc) {_ORDERED}) AS waited
  FROM stg_playback_events"""
BODIES["profile_pause_jump"] = _share(
    f"""SELECT case when moved < 0 then 'a. backwards (rewind)' when moved = 0 then 'b. same position (true pause)'
               when moved <= 60 then 'c. +1..60s (one heartbeat interval)' when moved <= 300 then 'd. +61..300s'
               else 'e. +300s or more (clear jump)' end AS playhead_move_across_pause,
          count(*) AS pauses
        FROM ({_NEXT}) WHERE event_type = 'pause' AND moved IS NOT NULL GROUP BY 1""",
    "pauses",
    1,
)
BODIES["profile_event_after_pause"] = f"""
SELECT next_type AS event_following_a_pause, count(*) AS occurrences
FROM ({_NEXT}) WHERE event_type = 'pause' AND next_type IS NOT NULL GROUP BY next_type"""
BODIES["profile_plays_per_session"] = """
SELECT n_play, count(*) AS sessions
FROM (SELECT count(*) FILTER (event_type = 'play') AS n_play FROM stg_playback_events GROUP BY session_id)
GROUP BY n_play"""
BODIES["sample_paused_session"] = """
SELECT event_type, event_at_utc, position_seconds FROM stg_playback_events
WHERE session_id = (SELECT min(session_id) FROM (SELECT session_id FROM stg_playback_events
                    WHERE event_type = 'pause' GROUP BY session_id HAVING count(*) = 1))
ORDER BY event_at_utc, position_seconds, event_id LIMIT 40"""
BODIES["profile_overlap_kind"] = """
SELECT case a.paid + b.paid when 2 then 'BOTH PAID (real problem)' when 1 then 'one paid, one trial-only'
            else 'both trial-only' end AS overlap_kind,
       count(*) AS overlapping_pairs, count(DISTINCT a.user_id) AS users
FROM spans a JOIN spans b ON a.user_id = b.user_id AND a.subscription_id < b.subscription_id
 AND a.first_ts <= b.last_ts AND b.first_ts <= a.last_ts
GROUP BY 1""".replace(
    "spans",
    f"""(SELECT user_id, subscription_id, min(effective_at_utc) AS first_ts, max(effective_at_utc) AS last_ts,
        bool_or(plan_type IN {values(PAID_PLANS)})::int AS paid
  FROM stg_subscriptions GROUP BY user_id, subscription_id)""",
)
BODIES["profile_concurrent_paid"] = """
SELECT count(*) AS truly_concurrent_paid_pairs, count(DISTINCT a.user_id) AS users_affected
FROM spans a JOIN spans b ON a.user_id = b.user_id AND a.subscription_id < b.subscription_id
 AND a.on_from < b.on_to AND b.on_from < a.on_to""".replace(
    "spans",
    f"""(SELECT user_id, subscription_id, min(effective_at_utc) FILTER (status = 'active') AS on_from,
        coalesce(min(effective_at_utc) FILTER (status IN {values(ENDED_STATES)}),
                 timestamp '2099-01-01 00:00:00') AS on_to
  FROM stg_subscriptions WHERE plan_type IN {values(PAID_PLANS)} GROUP BY user_id, subscription_id)""",
)
_BEATS = f"""SELECT session_id, lag(event_at_utc) {_ORDERED} AS before,
       date_diff('second', lag(event_at_utc) {_ORDERED}, event_at_utc) AS time_delta,
       position_seconds - lag(position_seconds) {_ORDERED} AS pos_delta
  FROM stg_playback_events WHERE event_type = 'heartbeat'"""
BODIES["profile_clock_vs_playhead"] = f"""
SELECT time_delta, pos_delta, count(*) AS occurrences,
       case when pos_delta = time_delta then if(time_delta = 60, 'normal playback',
                                                'dropped heartbeat(s), playhead kept pace')
            when pos_delta = 0 then 'STALLED (buffer or true pause)' when pos_delta > time_delta then 'SEEK FORWARD'
            when pos_delta < time_delta then 'playhead fell behind clock' else 'other' end AS interpretation
FROM ({_BEATS}) WHERE before IS NOT NULL GROUP BY time_delta, pos_delta
ORDER BY occurrences DESC, time_delta, pos_delta LIMIT 25"""
BODIES["profile_divergence_summary"] = f"""
SELECT count(*) AS intervals, count(*) FILTER (pos_delta = time_delta) AS playhead_tracks_clock,
       count(*) FILTER (pos_delta <> time_delta) AS diverges,
       count(DISTINCT if(pos_delta <> time_delta, session_id, null)) AS sessions_with_divergence
FROM ({_BEATS}) WHERE before IS NOT NULL"""
BODIES["profile_after_buffer"] = f"""
SELECT next_type AS event_after_buffer, count(*) AS occurrences, round(avg(waited), 1) AS avg_time_gap,
       round(avg(moved), 1) AS avg_position_gap
FROM ({_NEXT}) WHERE event_type = 'buffer' AND next_type IS NOT NULL GROUP BY next_type"""
BODIES["profile_stall_by_type"] = f"""
SELECT event_type, count(*) AS events, count(*) FILTER (step = 0) AS position_stalled,
       round(avg(step), 2) AS avg_pos_advance, round(avg(waited), 2) AS avg_time_advance
FROM (SELECT event_type, position_seconds - lag(position_seconds) {_ORDERED} AS step,
             date_diff('second', lag(event_at_utc) {_ORDERED}, event_at_utc) AS waited
      FROM stg_playback_events)
WHERE step IS NOT NULL GROUP BY event_type"""
BODIES["profile_cadence_regularity"] = f"""
SELECT case when odd = 0 then 'a. perfectly regular 60s' when odd = 1 then 'b. one irregular interval'
            when odd <= 3 then 'c. 2-3 irregular' else 'd. 4+ irregular' end AS pattern,
       count(*) AS sessions, sum(zero)::bigint AS total_zero_gap_intervals
FROM (SELECT session_id, count(*) FILTER (pos_delta <> 60) AS odd, count(*) FILTER (pos_delta = 0) AS zero
      FROM ({_BEATS}) GROUP BY session_id)
GROUP BY 1"""
BODIES["profile_zero_gap"] = f"""
SELECT time_delta AS time_gap_at_same_position, count(*) AS occurrences
FROM ({_BEATS}) WHERE pos_delta = 0 GROUP BY time_delta ORDER BY occurrences DESC, time_delta LIMIT 10"""

# ------------------------------------------------------------------ ad-hoc questions
_REPEATED = "(SELECT asset_id FROM raw_catalog GROUP BY asset_id HAVING count(*) > 1)"
BODIES["duplicated_assets"] = f"SELECT * FROM raw_catalog WHERE asset_id IN {_REPEATED}"
BODIES["ambiguous_playback"] = f"""
SELECT count(*) AS events, count(DISTINCT session_id) AS sessions FROM raw_events WHERE asset_id IN {_REPEATED}"""
BODIES["fanout_counts"] = _FANOUT.format("before_join", "after_inner", "after_left")
BODIES["encoding_share"] = _share(
    """SELECT if(regexp_full_match(event_ts, '[0-9]+'), 'epoch seconds',
                 if(event_ts LIKE '%T%Z', 'ISO-8601 Z', 'ISO space-separated (no tz)')) AS shape,
          count(*) AS rows, min(event_ts) AS example_min, max(event_ts) AS example_max
        FROM raw_events GROUP BY 1""",
    "rows",
    2,
)
BODIES["sub_encoding_share"] = """
SELECT if(event_effective_ts LIKE '%T%Z', 'ISO-8601 Z', 'ISO space-separated (no tz)') AS shape,
       count(*) AS rows
FROM raw_subs GROUP BY 1"""
BODIES["sport_variants"] = "SELECT sport, count(*) AS assets FROM raw_catalog GROUP BY sport"
BODIES["broken_durations"] = """
SELECT asset_id, asset_type, sport, title, duration_seconds FROM raw_catalog
WHERE try_cast(duration_seconds AS double) <= 0"""
BODIES["currency_by_plan"] = """
SELECT currency, plan_type, count(*) AS rows, min(mrr_amount) AS amt FROM raw_subs GROUP BY currency, plan_type"""


def statements() -> dict[str, str]:
    return {name: with_tables(body) for name, body in BODIES.items()}
