"""Roll an event stream up to one row per session."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sessionize(
    events: DataFrame,
    session: str,
    at: str,
    event_type: str,
    position: str,
    anonymous: str,
    invariant: Sequence[str],
) -> DataFrame:
    """Session attributes and measures in one aggregation.

    Beats are counted by distinct position, since repeated beats share one. The condition sits
    inside the distinct count, not in a FILTER clause, so Spark combines in two steps (session and
    position, then session) without expanding every row; a session of any size is spread over
    its positions before it meets in one task.
    """
    beat = F.col(event_type) == "heartbeat"
    beat_position = F.when(beat, F.col(position))
    return events.groupBy(session).agg(
        *[F.max(c).alias(c) for c in invariant],
        F.bool_and(anonymous).alias("is_anonymous_session"),
        F.min(at).alias("session_start_at_utc"),
        F.max(at).alias("session_end_at_utc"),
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct(beat_position).alias("watch_minutes"),
        F.count_if(F.col(event_type) == "buffer").alias("buffer_events"),
        F.max(beat_position).alias("max_heartbeat_position_seconds"),
    )
