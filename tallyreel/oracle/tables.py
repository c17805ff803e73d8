"""Common table expressions: the raw mapping, the staging layer and the marts, in DuckDB SQL."""

from __future__ import annotations

import re

from tallyreel.config import standard_config
from tallyreel.plans.marts_data import ENDED_STATES, PAID_PLANS
from tallyreel.sources.sample_feed import DEVICES, FIRST_EPOCH, SPORTS, STATES

_CONFIG = standard_config()
# Fixed value: stand-in for NULL inside a surrogate key's text.
KEY_NULL = "<null>"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def values(items) -> str:
    return "(" + ", ".join(f"'{v}'" for v in items) + ")"


def naive_time(text: str) -> str:
    digits = f"regexp_full_match({text}, '[0-9]+')"
    return (
        f"if({digits}, make_timestamp(try_cast({text} as bigint) * 1000000), "
        f"try_cast(if({text} like '%T%Z', translate({text}, 'TZ', ' '), {text}) as timestamp))"
    )


def encoding(text: str) -> str:
    return (
        f"case when {text} is null then 'iso8601_no_timezone_assumed_utc' "
        f"when regexp_full_match({text}, '[0-9]+') then 'epoch_seconds' "
        f"when {text} like '%T%Z' then 'iso8601_utc' else 'iso8601_no_timezone_assumed_utc' end"
    )


def row_key(*columns: str) -> str:
    filled = [f"coalesce(({c})::varchar, '{KEY_NULL}')" for c in columns]
    return f"md5({' || chr(45) || '.join(filled)})"


CTES: dict[str, str] = {}

# ------------------------------------------------------------------ raw layer
CTES["raw_users"] = f"""
SELECT c_custkey::varchar AS user_id,
       (date '2025-01-01' + (c_custkey % 240)::int)::varchar || 'T08:00:00Z' AS signup_ts,
       {_list(STATES)}[(c_custkey % 7)::int + 1] AS home_state,
       lower(c_mktsegment) AS acquisition_channel
FROM customer"""

CTES["raw_catalog"] = f"""
SELECT p_partkey::varchar AS asset_id,
       p_name || ' ' || p_partkey || if(copy = 1, ' (Replay)', '') AS title,
       if(copy = 0 AND p_partkey % 3 = 0, 'LIVE', 'VOD') AS asset_type,
       {_list(SPORTS)}[(p_partkey % 8)::int + 1] AS sport,
       p_brand AS home_school, p_type AS away_school,
       (date '2025-09-01' + (p_partkey % 150)::int)::varchar || 'T19:00:00Z' AS scheduled_start_ts,
       (case p_partkey % 40 when 3 then -600 when 4 then -1 when 5 then 0
             else 600 + (p_partkey % 40) * 90 end)::varchar AS duration_seconds
FROM part, (VALUES (0), (1)) AS copies(copy)
WHERE copy = 0 OR p_partkey % 29 = 0"""

CTES["feed_lines"] = """
SELECT s, rn, max(rn) OVER (PARTITION BY s) AS last_rn, s * 1000 + rn AS e
FROM (SELECT s, row_number() OVER (PARTITION BY s ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                                          l_extendedprice, l_quantity) AS rn
      FROM (SELECT *, (l_orderkey // 10) * 2 + if(l_orderkey % 10 > 1 + (l_orderkey // 10) % 7, 1, 0) AS s
            FROM lineitem))"""

CTES["feed_events"] = f"""
SELECT s, e,
       case when rn = 1 then 'play' when rn = last_rn then 'stop' when rn % 11 = 0 then 'pause'
            when rn % 13 = 0 then 'buffer' else 'heartbeat' end AS event_type,
       {FIRST_EPOCH} + (s % 180) * 86400 + (s % 24) * 3600 + rn * 60 AS t,
       rn * 60 + if(rn = last_rn, 237, 0) AS position
FROM feed_lines"""

CTES["raw_events"] = f"""
SELECT (e + shift)::varchar AS event_id, 's' || s AS session_id,
       (case when s % 6 = 0 then null when s % 41 = 0 then 900000 + s
             else (s * 7) % ((SELECT count(*) FROM customer) * 2 // 3) end)::varchar AS user_id,
       (if(s % 23 = 5, 800000 + s, (s * 11) % ((SELECT count(*) FROM part) // 2)))::varchar AS asset_id,
       event_type,
       case when e % 5 = 0 then t::varchar
            when e % 25 = 1 then strftime(make_timestamp(t * 1000000), '%Y/%m/%d %H:%M:%S')
            when e % 5 = 1 then strftime(make_timestamp(t * 1000000), '%Y-%m-%d %H:%M:%S')
            else strftime(make_timestamp(t * 1000000), '%Y-%m-%dT%H:%M:%SZ') end AS event_ts,
       position::varchar AS position_seconds,
       {_list(DEVICES)}[(s % 6)::int + 1] AS device_type,
       '5.' || (s % 4) AS app_version,
       (800 + (s % 53) * 100) || case s % 53 when 11 then '.5' when 12 then '.0' else '' end AS bitrate_kbps
FROM (SELECT *, 0 AS shift FROM feed_events
      UNION ALL SELECT *, 0 FROM feed_events WHERE e % 97 = 0
      UNION ALL SELECT *, 500 FROM feed_events WHERE e % 89 = 0 AND event_type = 'heartbeat')"""

CTES["raw_subs"] = """
SELECT sid::varchar AS subscription_id,
       (if(sid % 37 = 0, 900000 + sid, (sid * 7) % ((SELECT count(*) FROM customer) * 4 // 5)))::varchar
           AS user_id,
       plan_type,
       case when plan_type = 'free_trial' then if(step = 0, 'trialing', 'expired')
            when step = 1 then 'canceled' else 'active' end AS status,
       (date '2025-03-01' + ((sid * 11) % 307 + step * (20 + sid % 60))::int)::varchar
           || if((sid + step) % 7 = 0, ' 10:00:00', 'T10:00:00Z') AS event_effective_ts,
       case plan_type when 'annual' then '79.99' when 'monthly' then '9.99' else '0.00' end AS mrr_amount,
       case sid % 50 when 1 then 'GBP' when 2 then 'EUR' else 'USD' end AS currency
FROM (SELECT *, case when changes < 3 AND sid % 5 = 0 then 'free_trial'
                     when sid % 4 = 1 then 'annual' else 'monthly' end AS plan_type
      FROM (SELECT changes, (o_orderkey // 6) * 6 + (o_orderkey % 6) // changes AS sid,
                   (o_orderkey % 6) % changes AS step
            FROM (SELECT o_orderkey, (o_orderkey // 6) % 3 + 1 AS changes FROM orders)))"""

CTES["rates"] = """
SELECT * FROM (VALUES ('USD', 1.00::double, date '1900-01-01', date '2999-12-31'),
                      ('GBP', 1.27::double, date '1900-01-01', date '2999-12-31'),
                      ('EUR', 1.09::double, date '1900-01-01', date '2999-12-31'))
       AS r(currency, rate_to_usd, valid_from, valid_to)"""

# ------------------------------------------------------------------ staging
CTES["stg_playback_events"] = f"""
SELECT event_id::bigint AS event_id, session_id, user_id::bigint AS user_id, asset_id::bigint AS asset_id,
       event_type, {naive_time('event_ts')} AS event_at_utc, {encoding('event_ts')} AS event_ts_source_format,
       position_seconds::double AS position_seconds, device_type, app_version,
       bitrate_kbps::int AS bitrate_kbps, user_id IS NULL AS is_anonymous_view
FROM (SELECT DISTINCT ON (event_id) * FROM raw_events
      ORDER BY event_id, session_id, event_ts, position_seconds)"""

CTES["stg_asset_catalog"] = f"""
SELECT {row_key('asset_id', 'trim(title)', 'asset_type')} AS asset_key, asset_id::bigint AS asset_id,
       trim(title) AS title, asset_type, suffix(trim(title), '(Replay)') AS is_replay,
       coalesce(map {{'BBALL': 'BASKETBALL', 'VB': 'VOLLEYBALL', 'FB': 'FOOTBALL'}}[upper(trim(sport))],
                upper(trim(sport))) AS sport,
       sport AS sport_raw, trim(home_school) AS home_school, trim(away_school) AS away_school,
       {naive_time('scheduled_start_ts')} AS scheduled_start_at_utc,
       {encoding('scheduled_start_ts')} AS scheduled_start_ts_source_format,
       if(duration_seconds::double >= 1, duration_seconds::double, null) AS duration_seconds,
       duration_seconds::double AS duration_seconds_raw,
       duration_seconds::double < 1 AS has_invalid_duration
FROM raw_catalog"""

CTES["stg_subscriptions"] = f"""
SELECT {row_key('subscription_id', 'event_effective_ts')} AS subscription_change_key,
       subscription_id::bigint AS subscription_id, user_id::bigint AS user_id, plan_type, status,
       instant AS effective_at_utc, {encoding('event_effective_ts')} AS effective_ts_source_format,
       mrr_amount::double AS billing_period_amount, s.currency,
       round(mrr_amount::double * rate_to_usd, 2) AS usd_billing_period_amount,
       (map {{'monthly': 1, 'annual': 12, 'free_trial': 0}}[plan_type])::int AS billing_period_months
FROM (SELECT *, {naive_time('event_effective_ts')} AS instant FROM raw_subs) s
LEFT JOIN rates r ON r.currency = s.currency AND instant::date >= valid_from AND instant::date <= valid_to"""

CTES["stg_users"] = f"""
SELECT user_id::bigint AS user_id, {naive_time('signup_ts')} AS signup_at_utc,
       {encoding('signup_ts')} AS signup_ts_source_format,
       coalesce(map {{'FLORIDA': 'FL', 'TEXAS': 'TX', 'GEORGIA': 'GA', 'GA.': 'GA'}}[upper(trim(home_state))],
                upper(trim(home_state))) AS home_state,
       home_state AS home_state_raw, acquisition_channel
FROM raw_users"""

# ------------------------------------------------------------------ marts
CTES["dim_asset"] = """
SELECT asset_id, max(sport) AS sport, max(home_school) AS home_school, max(away_school) AS away_school,
       max(scheduled_start_at_utc) AS scheduled_start_at_utc, max(duration_seconds) AS duration_seconds,
       bool_or(has_invalid_duration) AS has_invalid_duration, count(*) AS source_row_count,
       count(*) > 1 AS has_ambiguous_identity
FROM stg_asset_catalog GROUP BY asset_id"""

CTES["dim_subscription_history"] = f"""
SELECT c.subscription_change_key, c.subscription_id, c.user_id, plan_type, status, currency,
       effective_at_utc AS valid_from,
       coalesce(following, timestamp '{_CONFIG.open_window_sentinel}') AS valid_to,
       following IS NULL AS is_current_state,
       if(billing_period_months = 0, 0.0::double, round(billing_period_amount / billing_period_months, 2))
           AS monthly_amount,
       if(billing_period_months = 0, 0.0::double, round(usd_billing_period_amount / billing_period_months, 2))
           AS usd_monthly_amount,
       billing_period_months, plan_type IN {values(PAID_PLANS)} AS is_paid_plan,
       status = 'active' AS is_active_state
FROM stg_subscriptions c
JOIN (SELECT subscription_change_key,
             lead(effective_at_utc) OVER (PARTITION BY subscription_id
                                          ORDER BY effective_at_utc, subscription_change_key) AS following
      FROM stg_subscriptions WHERE user_id IN (SELECT user_id FROM stg_users)) n
  USING (subscription_change_key)"""

CTES["spell_rows"] = """
SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY valid_from, valid_to, subscription_change_key
                           ROWS UNBOUNDED PRECEDING)::bigint AS spell_number
FROM (SELECT *, if(valid_from <= max(valid_to) OVER (
                       PARTITION BY user_id ORDER BY valid_from, valid_to, subscription_change_key
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0, 1) AS opens
      FROM dim_subscription_history WHERE is_paid_plan AND is_active_state)"""

CTES["fct_user_paid_spells"] = f"""
SELECT {row_key('user_id', 'spell_number')} AS paid_spell_key, user_id, spell_number,
       min(valid_from) AS paid_from, max(valid_to) AS paid_to, count(*) AS subscriptions_in_spell,
       count(DISTINCT subscription_id) AS distinct_subscriptions,
       bool_or(valid_to = timestamp '{_CONFIG.open_window_sentinel}') AS is_open_ended
FROM spell_rows GROUP BY user_id, spell_number"""

CTES["session_totals"] = """
SELECT session_id, max(user_id) AS user_id, max(asset_id) AS asset_id,
       bool_and(is_anonymous_view) AS is_anonymous_session, min(event_at_utc) AS session_start_at_utc,
       max(event_at_utc) AS session_end_at_utc, count(*) AS event_count,
       count(DISTINCT if(event_type = 'heartbeat', position_seconds, null)) AS watch_minutes,
       sum(if(event_type = 'buffer', 1, 0))::bigint AS buffer_events,
       max(if(event_type = 'heartbeat', position_seconds, null)) AS max_heartbeat_position_seconds,
       max(device_type) AS device_type, max(app_version) AS app_version, max(bitrate_kbps) AS bitrate_kbps
FROM stg_playback_events GROUP BY session_id"""

CTES["fct_session"] = """
SELECT t.*, sport, duration_seconds AS asset_duration_seconds,
       has_ambiguous_identity AS asset_identity_ambiguous,
       t.user_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stg_users u WHERE u.user_id = t.user_id)
           AS has_unknown_user,
       session_start_at_utc::date AS session_date,
       max_heartbeat_position_seconds / duration_seconds AS completion_pct,
       if(watch_minutes = 0, null, round(buffer_events * 10.0::double / watch_minutes, 3))
           AS buffers_per_10min
FROM session_totals t JOIN dim_asset a USING (asset_id)
WHERE duration_seconds IS NOT NULL"""

CTES["newest_change"] = "SELECT max(valid_from) AS newest FROM dim_subscription_history"

CTES["dim_user"] = f"""
SELECT u.user_id, signup_at_utc, signup_at_utc::date AS signup_date, home_state, acquisition_channel,
       coalesce(subscription_count, 0) AS subscription_count, first_subscription_at,
       latest_change_plan_type, latest_change_status, coalesce(has_ever_paid, false) AS has_ever_paid,
       coalesce(has_ever_churned, false) AS has_ever_churned,
       coalesce(is_currently_subscribed, false) AS is_currently_subscribed,
       coalesce(current_usd_mrr, 0.0::double) AS current_usd_mrr,
       coalesce(paid_spell_count, 0) AS paid_spell_count, first_paid_at,
       coalesce(total_paid_days, 0) AS total_paid_days, s.user_id IS NOT NULL AS has_subscription
FROM stg_users u
LEFT JOIN (
    SELECT user_id, count(DISTINCT subscription_id) AS subscription_count,
           min(valid_from) AS first_subscription_at,
           arg_max(plan_type, (valid_from, subscription_change_key)) FILTER (is_current_state)
               AS latest_change_plan_type,
           arg_max(status, (valid_from, subscription_change_key)) FILTER (is_current_state)
               AS latest_change_status,
           bool_or(is_paid_plan) AS has_ever_paid,
           bool_or(is_paid_plan AND status IN {values(ENDED_STATES)}) AS has_ever_churned,
           bool_or(is_current_state AND status = 'active') AS is_currently_subscribed,
           round(coalesce(sum(usd_monthly_amount) FILTER (is_current_state AND status = 'active'), 0), 2)
               AS current_usd_mrr
    FROM dim_subscription_history GROUP BY user_id) s ON s.user_id = u.user_id
LEFT JOIN (
    SELECT user_id, count(*) AS paid_spell_count, min(paid_from) AS first_paid_at,
           sum(least(paid_to, newest)::date - paid_from::date)::bigint AS total_paid_days
    FROM fct_user_paid_spells, newest_change GROUP BY user_id) p ON p.user_id = u.user_id"""

CTES["fct_session_engagement"] = f"""
SELECT session_id, user_id, asset_id, session_date, completion_pct,
       completion_pct >= {_CONFIG.engaged_min_completion}::double AS is_engaged_view,
       if(completion_pct < {_CONFIG.sampled_min_completion}::double, 'abandoned',
          if(completion_pct < {_CONFIG.engaged_min_completion}::double, 'sampled', 'engaged'))
           AS engagement_tier
FROM fct_session"""

CTES["fct_user_engagement"] = f"""
SELECT u.user_id, signup_date, home_state, acquisition_channel,
       coalesce(n, 0) AS session_count, coalesce(n_engaged, 0) AS engaged_session_count,
       coalesce(assets, 0) AS distinct_assets_watched, coalesce(sports, 0) AS distinct_sports_watched,
       coalesce(minutes, 0) AS total_watch_minutes, coalesce(engaged_minutes, 0) AS engaged_watch_minutes,
       coalesce(days, 0) AS active_days, best AS best_completion_pct, mean AS avg_completion_pct,
       first_at AS first_session_at, last_at AS last_session_at, coalesce(n_engaged, 0) > 0 AS is_engaged_user,
       case when n IS NULL then 'never_watched' when n_engaged > 0 then 'engaged'
            when best >= {_CONFIG.sampled_min_completion}::double then 'sampled'
            else 'abandoned' end AS engagement_tier,
       has_subscription, subscription_count, latest_change_plan_type, latest_change_status, has_ever_paid,
       has_ever_churned, is_currently_subscribed, current_usd_mrr, paid_spell_count, total_paid_days,
       first_paid_at, has_ever_paid AND NOT is_currently_subscribed AS has_churned_from_paid
FROM dim_user u
LEFT JOIN (
    SELECT f.user_id, count(*) AS n, sum(is_engaged_view::int)::bigint AS n_engaged,
           count(DISTINCT f.asset_id) AS assets, count(DISTINCT sport) AS sports,
           sum(watch_minutes)::bigint AS minutes,
           sum(if(is_engaged_view, watch_minutes, 0))::bigint AS engaged_minutes,
           count(DISTINCT session_start_at_utc::date) AS days, max(f.completion_pct) AS best,
           sum(floor(f.completion_pct * 1e12 + 0.5)::hugeint)::double / 1e12 / count(f.completion_pct) AS mean, min(session_start_at_utc) AS first_at,
           max(session_end_at_utc) AS last_at
    FROM fct_session f JOIN fct_session_engagement g ON g.session_id = f.session_id
    WHERE f.user_id IS NOT NULL GROUP BY f.user_id) m ON m.user_id = u.user_id"""

_ORDER = list(CTES)
_WORD = re.compile(r"[a-z_]+")


def with_tables(body: str) -> str:
    """Prefix a query with the expressions it needs, directly or through others."""
    needed: set[str] = set()
    pending = [body]
    while pending:
        words = set(_WORD.findall(pending.pop()))
        for name in words & CTES.keys() - needed:
            needed.add(name)
            pending.append(CTES[name])
    parts = [f"{name} AS ({CTES[name].strip()})" for name in _ORDER if name in needed]
    if not parts:
        return body.strip()
    head = "WITH " + ",\n".join(parts)
    return f"{head}\n{body.strip()}"
