"""Project-level knobs. Transforms take a config object; none of them has a default inside."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class EngineConfig:
    """Thresholds are opinions, so they carry no default: whoever builds a config states them."""

    engaged_min_completion: float
    sampled_min_completion: float
    open_window_sentinel: str
    # Groups (one session, one user, ...) above this many rows are cut into ordered pieces
    # before a window runs over them, so no task ever holds more than about this many rows
    # of one group. See operators/split_window.py. It decides plans only, never results.
    max_group_rows: int = 2_000_000


def standard_config() -> EngineConfig:
    # The published thresholds and the open-window marker.
    return EngineConfig(
        engaged_min_completion=0.30,
        sampled_min_completion=0.10,
        open_window_sentinel="2999-12-31 23:59:59",
    )
