"""Sessions on raw text: volume, composition, stop and completion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyreel.functions.cleaning import numeric_or_null
from tallyreel.functions.numeric import decile_clamp_then_floor, decile_floor_then_clamp, percent, round_half_away
from tallyreel.operators.classify import bucketize_labels
from tallyreel.operators.dedupe import dedupe_first
from tallyreel.operators.distinct import distinct_counts
from tallyreel.operators.quantiles import exact_quantiles
from tallyreel.operators.split_window import HotGroups, Lag, ordered_columns
from tallyreel.profiling.shared import row_count, stacked, top, with_share

POSITION = numeric_or_null


def _kind(name: str) -> Column:
    return F.col("event_type") == name


def _furthest(kind: str) -> Column:
    return F.max(F.when(_kind(kind), POSITION(F.col("position_seconds"))))


def session_volume(events: DataFrame) -> DataFrame:
    counted = distinct_counts(
        events,
        [],
        {"sessions": "session_id", "distinct_users": "user_id", "distinct_assets": "asset_id"},
        {"events": F.lit(True)},
    )
    per_session = F.col("events") / F.nullif(F.col("sessions"), F.lit(0))
    return counted.select(
        "sessions",
        "events",
        round_half_away(per_session, 2).alias("events_per_session"),
        "distinct_users",
        "distinct_assets",
    )


def session_invariants(events: DataFrame) -> DataFrame:
    """Sessions that span several assets or users; smallest <> largest spares a distinct count."""
    several = {c: F.min(c) != F.max(c) for c in ("asset_id", "user_id")}
    per_session = events.groupBy("session_id").agg(
        several["asset_id"].alias("assets"), several["user_id"].alias("users")
    )
    return per_session.agg(
        F.count_if("assets").alias("sessions_multi_asset"),
        F.count_if("users").alias("sessions_multi_user"),
        row_count().alias("total_sessions"),
    )


def session_composition(events: DataFrame) -> DataFrame:
    flags = {f"has_{k}": F.max(F.when(_kind(k), 1).otherwise(0)) for k in ("play", "stop")}
    per_session = events.groupBy("session_id").agg(*[c.alias(n) for n, c in flags.items()])
    return (
        per_session.groupBy(*flags)
        .agg(row_count().alias("sessions"))
        .orderBy(F.desc("has_play"), F.desc("has_stop"))
    )


def null_pattern(events: DataFrame) -> DataFrame:
    per_session = events.groupBy("session_id").agg(
        row_count().alias("n_events"), F.count_if(F.col("user_id").isNull()).alias("n_null")
    )
    # Pattern labels.
    pattern = bucketize_labels(
        [
            (F.col("n_null") == 0, "no nulls"),
            (F.col("n_null") == F.col("n_events"), "entire session anonymous"),
        ],
        "MIXED within session",
    )
    return (
        per_session.groupBy(pattern.alias("pattern"))
        .agg(row_count().alias("sessions"), F.sum("n_events").alias("events"))
        .orderBy(F.desc("sessions"), "pattern")
    )


def events_per_session(events: DataFrame, kind: str, name: str) -> DataFrame:
    """Histogram: how many events of one kind a session has."""
    per_session = events.groupBy("session_id").agg(F.count_if(_kind(kind)).alias(name))
    return per_session.groupBy(name).agg(row_count().alias("sessions")).orderBy(name)


def runtimes(catalog: DataFrame) -> DataFrame:
    """One runtime per asset id: the first row by title, then by the other columns."""
    first = dedupe_first(catalog, ["asset_id"], ["title", "asset_type"])
    return first.select("asset_id", "asset_type", numeric_or_null(F.col("duration_seconds")).alias("dur"))


def session_asset_measures(events: DataFrame) -> DataFrame:
    """Positions per session and asset. Events are combined here, before any join to the catalog,
    so the join moves one row per session; unused measures are pruned from the plan."""
    return events.groupBy("session_id", "asset_id").agg(
        F.max(POSITION(F.col("position_seconds"))).alias("max_pos"),
        _furthest("stop").alias("stop_pos"),
        _furthest("pause").alias("pause_pos"),
        F.count_if(_kind("pause")).alias("n_pause"),
    )


def on_runtime(measures: DataFrame, catalog: DataFrame, positive: bool = True) -> DataFrame:
    known = runtimes(catalog)
    if positive:
        known = known.filter(F.col("dur") > 0)
    return measures.join(known, "asset_id")


def position_vs_duration(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """Events whose playhead lies past the end. Equal positions of one asset join as one row."""
    pos, dur, n = F.col("pos"), F.col("dur"), F.col("n")
    placed = events.groupBy("asset_id", POSITION(F.col("position_seconds")).alias("pos")).agg(
        row_count().alias("n")
    )
    checked = on_runtime(placed, catalog)
    return checked.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("events_checked"),
        F.coalesce(F.sum(F.when(pos > dur, n)), F.lit(0)).alias("pos_beyond_duration"),
        F.coalesce(F.sum(F.when(pos > dur * F.lit(1.05), n)), F.lit(0)).alias("pos_beyond_duration_5pct"),
        round_half_away(F.max(pos / dur), 3).alias("max_ratio"),
    )


def heartbeat_gaps(events: DataFrame, hot: HotGroups | None) -> DataFrame:
    """Position gap to the previous heartbeat of the session, in position order."""
    beats = events.filter(_kind("heartbeat")).select(
        "session_id", POSITION(F.col("position_seconds")).alias("pos"), "event_id"
    )
    ordered = ordered_columns(beats, ["session_id"], ["pos", "event_id"], {"prev_pos": Lag("pos")}, hot)
    return ordered.select("session_id", (F.col("pos") - F.col("prev_pos")).alias("gap_seconds"))


def heartbeat_cadence(events: DataFrame, hot: HotGroups | None, limit: int | None) -> DataFrame:
    counted = (
        heartbeat_gaps(events, hot)
        .filter(F.col("gap_seconds").isNotNull())
        .groupBy("gap_seconds")
        .agg(row_count().alias("occurrences"))
    )
    order = [F.desc("occurrences"), F.asc("gap_seconds")]
    return counted.orderBy(*order) if limit is None else top(counted, order, limit)


def position_jumps(events: DataFrame, hot: HotGroups | None, longest_normal: float = 60.0) -> DataFrame:
    gap = F.col("gap_seconds")
    per_session = (
        heartbeat_gaps(events, hot)
        .groupBy("session_id")
        .agg(F.count_if(gap > longest_normal).alias("jumps"), F.max(gap).alias("largest"))
    )
    return per_session.agg(
        F.count_if(F.col("jumps") > 0).alias("sessions_with_a_jump"),
        F.coalesce(F.sum("jumps"), F.lit(0)).alias("jump_count"),
        F.max("largest").alias("largest_jump_seconds"),
    )


def quantile_report(per_entity: DataFrame, metrics: dict[str, str], fractions: Sequence[float]) -> DataFrame:
    """Exact quantiles of several per-entity measures, in long form."""
    cells = [
        F.struct(F.lit(label).alias("metric"), F.col(column).cast("double").alias("v"))
        for column, label in metrics.items()
    ]
    long = per_entity.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*")
    return exact_quantiles(long, "metric", "v", fractions, few_groups=True)


def session_quantiles(events: DataFrame) -> DataFrame:
    per_session = events.groupBy("session_id").agg(
        F.count_if(_kind("heartbeat")).alias("n_heartbeats"),
        F.max(POSITION(F.col("position_seconds"))).alias("max_pos"),
    )
    metrics = {"n_heartbeats": "heartbeats_pctiles", "max_pos": "max_position_pctiles"}
    return quantile_report(per_session, metrics, [0, 0.1, 0.25, 0.5, 0.75, 0.9, 1])


def completion_histogram(events: DataFrame, catalog: DataFrame, clamp_first: bool) -> DataFrame:
    per_session = (
        on_runtime(session_asset_measures(events), catalog, positive=False)
        .groupBy("session_id")
        .agg(F.max("max_pos").alias("max_pos"), F.max("dur").alias("dur"))
        .filter(F.col("dur") > 0)
    )
    ratio = F.col("max_pos") / F.col("dur")
    bucket = decile_clamp_then_floor(ratio) if clamp_first else decile_floor_then_clamp(ratio)
    return (
        per_session.groupBy(round_half_away(bucket, 1).alias("completion_bucket"))
        .agg(row_count().alias("sessions"))
        .orderBy("completion_bucket")
    )


def _stops(events: DataFrame, catalog: DataFrame, *extra: str) -> DataFrame:
    return (
        on_runtime(session_asset_measures(events), catalog)
        .groupBy("session_id", "dur", *extra)
        .agg(F.max("stop_pos").alias("stop_pos"))
        .filter(F.col("stop_pos").isNotNull())
        .withColumn("ratio", F.col("stop_pos") / F.col("dur"))
    )


def stop_vs_duration(events: DataFrame, catalog: DataFrame) -> DataFrame:
    ratio = F.col("ratio")
    # Band labels and edges.
    band = bucketize_labels(
        [
            (ratio >= 0.98, "a. >=98% of asset (natural end)"),
            (ratio >= 0.90, "b. 90-98%"),
            (ratio >= 0.50, "c. 50-90%"),
            (ratio >= 0.10, "d. 10-50%"),
        ],
        "e. <10% (early abandon)",
    )
    counted = _stops(events, catalog).groupBy(band.alias("stop_point")).agg(row_count().alias("sessions"))
    return with_share(counted, "sessions", 1).orderBy("stop_point")


def stop_vs_heartbeat(events: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Is stop the last heartbeat? ``labels``: identical, later, then earlier and anything NULL,
    the last two falling together when only three labels are given."""
    per_session = events.groupBy("session_id").agg(
        _furthest("stop").alias("stop_pos"), _furthest("heartbeat").alias("last_hb")
    )
    stop, beat = F.col("stop_pos"), F.col("last_hb")
    bands = [(stop == beat, labels[0]), (stop > beat, labels[1])]
    if len(labels) == 4:
        bands.append((stop < beat, labels[2]))
    return (
        per_session.groupBy(bucketize_labels(bands, labels[-1]).alias("relation"))
        .agg(
            row_count().alias("sessions"),
            round_half_away(F.avg(stop - beat), 1).alias("avg_gap_seconds"),
        )
        .orderBy(F.desc("sessions"), "relation")
    )


def stop_by_type(events: DataFrame, catalog: DataFrame) -> DataFrame:
    ratio = F.col("ratio")
    stops = _stops(events, catalog, "asset_type")
    averages = stops.groupBy("asset_type").agg(
        row_count().alias("sessions"),
        round_half_away(F.avg(ratio), 3).alias("avg_completion_at_stop"),
        F.count_if(ratio >= 0.98).alias("reached_98pct"),
    )
    medians = exact_quantiles(stops, "asset_type", "ratio", [0.5]).select(
        F.col("asset_type").alias("_type"), round_half_away(F.col("value"), 3).alias("median_completion_at_stop")
    )
    return (
        averages.join(medians, F.col("asset_type").eqNullSafe(F.col("_type")), "left")
        .select(
            "asset_type",
            "sessions",
            "avg_completion_at_stop",
            "median_completion_at_stop",
            "reached_98pct",
        )
        .orderBy("asset_type")
    )


def pause_behaviour(events: DataFrame, catalog: DataFrame) -> DataFrame:
    per_session = (
        on_runtime(session_asset_measures(events), catalog)
        .groupBy("session_id", "dur")
        .agg(
            F.sum("n_pause").alias("n_pause"),
            F.max("pause_pos").alias("pause_pos"),
            F.max("max_pos").alias("max_pos"),
        )
    )
    # State labels.
    state = bucketize_labels([(F.col("n_pause") == 0, "no pause")], "has pause")
    return (
        per_session.groupBy(state.alias("pause_state"))
        .agg(
            row_count().alias("sessions"),
            round_half_away(F.avg(F.col("max_pos") / F.col("dur")), 3).alias("avg_completion"),
            F.count_if(F.col("max_pos") > F.col("pause_pos")).alias("resumed_past_pause"),
        )
        .orderBy("pause_state")
    )


# ------------------------------------------------------------------ return viewing


def _identified(events: DataFrame) -> DataFrame:
    return events.filter(F.col("user_id").isNotNull())


def _sessions_per_pair(events: DataFrame) -> DataFrame:
    return (
        _identified(events)
        .groupBy("user_id", "asset_id")
        .agg(F.count_distinct("session_id").alias("sessions_on_asset"))
    )


def sessions_per_user_asset(events: DataFrame) -> DataFrame:
    return (
        _sessions_per_pair(events)
        .groupBy("sessions_on_asset")
        .agg(row_count().alias("user_asset_pairs"))
        .orderBy("sessions_on_asset")
    )


def rewatchers(events: DataFrame) -> DataFrame:
    per_user = _sessions_per_pair(events).groupBy("user_id").agg(
        F.bool_or(F.col("sessions_on_asset") > 1).alias("repeats")
    )
    return per_user.agg(
        row_count().alias("users_with_playback"), F.count_if("repeats").alias("users_who_rewatch")
    )


def grain_comparison(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """Completion per session beside completion per user and asset."""
    per_session = (
        _identified(events)
        .groupBy("user_id", "asset_id", "session_id")
        .agg(F.max(POSITION(F.col("position_seconds"))).alias("best"))
    )
    sessions = on_runtime(per_session, catalog)
    pairs = sessions.groupBy("user_id", "asset_id").agg(
        F.max("dur").alias("dur"), F.max("best").alias("best")
    )
    ratio = F.col("best") / F.col("dur")

    def summary(label: str, df: DataFrame) -> DataFrame:
        return df.agg(
            row_count().alias("units"),
            round_half_away(F.avg(ratio), 4).alias("avg_completion"),
            F.count_if(ratio > 0.2).alias("above_0_2"),
        ).select(
            F.lit(label).alias("grain"),
            "units",
            "avg_completion",
            "above_0_2",
            percent(F.col("above_0_2"), F.col("units"), 1).alias("pct_above_0_2"),
        )

    # Grain labels.
    return stacked([summary("per session", sessions), summary("per (user, asset)", pairs)])


def resume_or_restart(events: DataFrame, near_start: float = 60.0) -> DataFrame:
    """Later sessions of one user on one asset: from the start, or further in?

    Sessions are ranked by where they start, so the first of a pair is the one with the smallest
    start. Counting both classes and taking that one away needs no window.
    """
    starts = (
        _identified(events)
        .groupBy("user_id", "asset_id", "session_id")
        .agg(F.min(POSITION(F.col("position_seconds"))).alias("min_pos"))
    )
    near = F.col("min_pos") <= near_start
    pairs = starts.groupBy("user_id", "asset_id").agg(
        row_count().alias("n"),
        F.count_if(near).alias("near"),
        F.coalesce(F.min("min_pos") <= near_start, F.lit(False)).alias("first_near"),
    ).filter("n > 1")
    restarts = F.sum(F.col("near") - F.col("first_near").cast("int"))
    later = F.sum(F.col("n") - F.col("near") - (~F.col("first_near")).cast("int"))
    # Behaviour labels.
    rows = F.array(
        F.struct(
            F.lit("restarts near 0 (min_pos <= 60s)").alias("second_session_behaviour"),
            F.col("restarts").alias("sessions"),
        ),
        F.struct(
            F.lit("starts later in the asset (resume-like)").alias("second_session_behaviour"),
            F.col("later").alias("sessions"),
        ),
    )
    return (
        pairs.agg(restarts.alias("restarts"), later.alias("later"))
        .select(F.explode(rows).alias("_r"))
        .select("_r.*")
        .filter("sessions > 0")
        .orderBy(F.desc("sessions"), "second_session_behaviour")
    )


def user_quantiles(events: DataFrame) -> DataFrame:
    per_user = distinct_counts(
        _identified(events),
        ["user_id"],
        {"sessions": "session_id", "assets": "asset_id"},
        {"heartbeats": _kind("heartbeat")},
    )
    # Metric labels.
    metrics = {
        "sessions": "sessions per user",
        "assets": "assets per user",
        "heartbeats": "heartbeats (mins) per user",
    }
    return quantile_report(per_user, metrics, [0, 0.25, 0.5, 0.75, 0.9, 1])
