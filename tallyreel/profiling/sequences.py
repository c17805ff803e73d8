"""Order of events inside a session, on cleaned events: clock against playhead."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyreel.functions.numeric import round_half_away
from tallyreel.functions.timestamps import seconds_between
from tallyreel.operators.classify import bucketize_labels
from tallyreel.operators.split_window import HotGroups, Lag, Lead, Spec, ordered_columns
from tallyreel.profiling.shared import row_count, top, with_share

# Time alone leaves ties: repeated beats share time and position, so the id decides.
ORDER = ["event_at_utc", "position_seconds", "event_id"]
BEAT_SECONDS = 60  # Fixed value: heartbeats come once a minute.


def _in_order(events: DataFrame, new: Mapping[str, Spec], hot: HotGroups | None, *extra: str) -> DataFrame:
    narrow = events.select("session_id", *ORDER, *extra)
    return ordered_columns(narrow, ["session_id"], ORDER, new, hot)


def _beats(events: DataFrame, hot: HotGroups | None) -> DataFrame:
    """Heartbeats with time and position gained since the previous one. Filtered before ordering."""
    beats = _in_order(
        events.filter(F.col("event_type") == "heartbeat"),
        {"prev_ts": Lag("event_at_utc"), "prev_pos": Lag("position_seconds")},
        hot,
    )
    return beats.withColumns(
        {
            "time_delta": seconds_between(F.col("prev_ts"), F.col("event_at_utc")),
            "pos_delta": F.col("position_seconds") - F.col("prev_pos"),
        }
    )


def sequence_sanity(events: DataFrame, hot: HotGroups | None) -> DataFrame:
    pos, prev = F.col("position_seconds"), F.col("prev_pos")
    steps = _in_order(events, {"prev_pos": Lag("position_seconds")}, hot).filter(prev.isNotNull())
    return steps.agg(
        row_count().alias("transitions"),
        F.count_if(pos < prev).alias("position_goes_backwards"),
        F.count_if(pos == prev).alias("position_unchanged"),
    )


def pause_jump(events: DataFrame, hot: HotGroups | None) -> DataFrame:
    steps = _in_order(events, {"next_pos": Lead("position_seconds")}, hot, "event_type")
    pauses = steps.filter((F.col("event_type") == "pause") & F.col("next_pos").isNotNull())
    jump = F.col("next_pos") - F.col("position_seconds")
    # Band labels and edges.
    band = bucketize_labels(
        [
            (jump < 0, "a. backwards (rewind)"),
            (jump == 0, "b. same position (true pause)"),
            (jump <= 60, "c. +1..60s (one heartbeat interval)"),
            (jump <= 300, "d. +61..300s"),
        ],
        "e. +300s or more (clear jump)",
    )
    counted = pauses.groupBy(band.alias("playhead_move_across_pause")).agg(row_count().alias("pauses"))
    return with_share(counted, "pauses", 1).orderBy("playhead_move_across_pause")


def _after(events: DataFrame, kind: str, hot: HotGroups | None) -> DataFrame:
    new = {
        "next_type": Lead("event_type"),
        "next_ts": Lead("event_at_utc"),
        "next_pos": Lead("position_seconds"),
    }
    steps = _in_order(events, new, hot, "event_type")
    return steps.filter((F.col("event_type") == kind) & F.col("next_type").isNotNull())


def event_after_pause(events: DataFrame, hot: HotGroups | None) -> DataFrame:
    return (
        _after(events, "pause", hot)
        .groupBy(F.col("next_type").alias("event_following_a_pause"))
        .agg(row_count().alias("occurrences"))
        .orderBy(F.desc("occurrences"), "event_following_a_pause")
    )


def sample_paused_session(events: DataFrame, limit: int = 40) -> DataFrame:
    """The first session with exactly one pause, in order."""
    pauses = events.filter(F.col("event_type") == "pause").groupBy("session_id").agg(row_count().alias("n"))
    chosen = pauses.filter("n = 1").agg(F.min("session_id")).scalar()
    rows = events.filter(F.col("session_id") == chosen)
    return top(rows, [F.col(c) for c in ORDER], limit).select("event_type", "event_at_utc", "position_seconds")


def clock_vs_playhead(events: DataFrame, hot: HotGroups | None, limit: int = 25) -> DataFrame:
    """Time gained against position gained between heartbeats, most frequent first."""
    counted = (
        _beats(events, hot)
        .filter(F.col("prev_ts").isNotNull())
        .groupBy("time_delta", "pos_delta")
        .agg(row_count().alias("occurrences"))
    )
    order = [F.desc("occurrences"), F.col("time_delta").asc_nulls_last(), F.col("pos_delta").asc_nulls_last()]
    return top(counted, order, limit).select("time_delta", "pos_delta", "occurrences", interpretation())


def interpretation() -> Column:
    """Equality comes first: a repeated beat (no time, no move) is not a stall."""
    time, pos = F.col("time_delta"), F.col("pos_delta")
    # Interpretation labels.
    return bucketize_labels(
        [
            ((pos == time) & (time == BEAT_SECONDS), "normal playback"),
            (pos == time, "dropped heartbeat(s), playhead kept pace"),
            (pos == 0, "STALLED (buffer or true pause)"),
            (pos > time, "SEEK FORWARD"),
            (pos < time, "playhead fell behind clock"),
        ],
        "other",
    ).alias("interpretation")


def divergence_summary(events: DataFrame, hot: HotGroups | None) -> DataFrame:
    diverges = F.col("pos_delta") != F.col("time_delta")
    # Combined per session first; beats are already placed by session.
    per_session = (
        _beats(events, hot)
        .filter(F.col("prev_ts").isNotNull())
        .groupBy("session_id")
        .agg(
            row_count().alias("n"),
            F.count_if(F.col("pos_delta") == F.col("time_delta")).alias("tracks"),
            F.count_if(diverges).alias("diverging"),
        )
    )
    return per_session.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("intervals"),
        F.coalesce(F.sum("tracks"), F.lit(0)).alias("playhead_tracks_clock"),
        F.coalesce(F.sum("diverging"), F.lit(0)).alias("diverges"),
        F.count_if(F.col("diverging") > 0).alias("sessions_with_divergence"),
    )


def after_buffer(events: DataFrame, hot: HotGroups | None) -> DataFrame:
    waited = seconds_between(F.col("event_at_utc"), F.col("next_ts"))
    return (
        _after(events, "buffer", hot)
        .groupBy(F.col("next_type").alias("event_after_buffer"))
        .agg(
            row_count().alias("occurrences"),
            round_half_away(F.avg(waited), 1).alias("avg_time_gap"),
            round_half_away(F.avg(F.col("next_pos") - F.col("position_seconds")), 1).alias("avg_position_gap"),
        )
        .orderBy(F.desc("occurrences"), "event_after_buffer")
    )


def stall_by_type(events: DataFrame, hot: HotGroups | None) -> DataFrame:
    new = {"prev_pos": Lag("position_seconds"), "prev_ts": Lag("event_at_utc")}
    pos, prev = F.col("position_seconds"), F.col("prev_pos")
    waited = seconds_between(F.col("prev_ts"), F.col("event_at_utc"))
    return (
        _in_order(events, new, hot, "event_type")
        .filter(prev.isNotNull())
        .groupBy("event_type")
        .agg(
            row_count().alias("events"),
            F.count_if(pos == prev).alias("position_stalled"),
            round_half_away(F.avg(pos - prev), 2).alias("avg_pos_advance"),
            round_half_away(F.avg(waited), 2).alias("avg_time_advance"),
        )
        .orderBy("event_type")
    )


def cadence_regularity(events: DataFrame, hot: HotGroups | None) -> DataFrame:
    gap, odd = F.col("pos_delta"), F.col("irregular")
    per_session = (
        _beats(events, hot)
        .groupBy("session_id")
        .agg(F.count_if(gap != BEAT_SECONDS).alias("irregular"), F.count_if(gap == 0).alias("zero_gaps"))
    )
    # Pattern labels.
    pattern = bucketize_labels(
        [
            (odd == 0, "a. perfectly regular 60s"),
            (odd == 1, "b. one irregular interval"),
            (odd <= 3, "c. 2-3 irregular"),
        ],
        "d. 4+ irregular",
    )
    return (
        per_session.groupBy(pattern.alias("pattern"))
        .agg(row_count().alias("sessions"), F.sum("zero_gaps").alias("total_zero_gap_intervals"))
        .orderBy("pattern")
    )


def zero_gap(events: DataFrame, hot: HotGroups | None, limit: int = 10) -> DataFrame:
    counted = (
        _beats(events, hot)
        .filter(F.col("position_seconds") == F.col("prev_pos"))
        .groupBy(F.col("time_delta").alias("time_gap_at_same_position"))
        .agg(row_count().alias("occurrences"))
    )
    order = [F.desc("occurrences"), F.col("time_gap_at_same_position").asc_nulls_last()]
    return top(counted, order, limit)
