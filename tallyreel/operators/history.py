"""Type-2 validity windows from a change log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyreel.operators.split_window import HotGroups, Lead, ordered_columns


def scd2_windows(
    changes: DataFrame,
    entity: str,
    effective: str,
    tie_break: str,
    sentinel: str,
    hot: HotGroups | None = None,
) -> DataFrame:
    """Each change is valid until the entity's next change: ``[valid_from, valid_to)``.

    The last change stays open and carries the sentinel as its end.
    """
    open_end = F.to_timestamp_ntz(F.lit(sentinel))
    followed = ordered_columns(changes, [entity], [effective, tie_break], {"_next": Lead(effective)}, hot)
    return followed.withColumns(
        {
            "valid_from": F.col(effective),
            "valid_to": F.coalesce(F.col("_next"), open_end),
            "is_current_state": F.col("_next").isNull(),
        }
    ).drop("_next")
