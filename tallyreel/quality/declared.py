"""The declared checks, as data: which columns of which table must hold what."""

from __future__ import annotations

from dataclasses import dataclass, field

# Accepted values and value ranges.
SPORT_NAMES = [
    "BASEBALL",
    "BASKETBALL",
    "FOOTBALL",
    "HOCKEY",
    "LACROSSE",
    "SOCCER",
    "SOFTBALL",
    "TRACK",
    "VOLLEYBALL",
    "WRESTLING",
]
CHANNELS = ["organic", "paid_social", "referral", "partner", "school_email", "app_store"]
EVENT_TYPES = ["play", "pause", "buffer", "heartbeat", "stop"]
DEVICE_TYPES = ["ios", "android", "web", "roku", "firetv", "appletv"]
PLAN_TYPES = ["monthly", "annual", "free_trial"]
STATUSES = ["trialing", "active", "canceled", "expired"]
CURRENCIES = ["USD", "GBP", "EUR"]
ASSET_TYPES = ["LIVE", "VOD"]
ENCODINGS = ["epoch_seconds", "iso8601_utc", "iso8601_no_timezone_assumed_utc"]
EVENT_RANGE = "event_at_utc BETWEEN timestamp_ntz'2020-01-01 00:00:00' AND timestamp_ntz'2027-01-01 00:00:00'"
STATE_SHAPE = "length(home_state) = 2"


@dataclass(frozen=True)
class Declared:
    """Checks of one table. ``relationships``: column, parent table, parent column."""

    table: str
    not_null: list[str]
    accepted: dict[str, list] = field(default_factory=dict)
    unique: list[str] = field(default_factory=list)
    unique_together: list[list[str]] = field(default_factory=list)
    relationships: list[tuple[str, str, str]] = field(default_factory=list)
    expressions: list[str] = field(default_factory=list)

    def count(self) -> int:
        parts = (
            self.not_null,
            self.accepted,
            self.unique,
            self.unique_together,
            self.relationships,
            self.expressions,
        )
        return sum(len(p) for p in parts)


# Which columns of which table each check covers, here and below.
def source_checks(channels: list[str] = CHANNELS) -> list[Declared]:
    return [
        Declared(
            "raw_playback_events",
            ["event_id", "session_id", "asset_id", "event_type", "event_ts", "position_seconds"],
            {"event_type": EVENT_TYPES, "device_type": DEVICE_TYPES},
        ),
        Declared(
            "raw_subscriptions",
            ["subscription_id", "user_id", "event_effective_ts", "mrr_amount"],
            {"plan_type": PLAN_TYPES, "status": STATUSES, "currency": CURRENCIES},
            unique_together=[["subscription_id", "event_effective_ts"]],
        ),
        Declared(
            "raw_asset_catalog",
            ["asset_id", "asset_type", "sport", "duration_seconds", "scheduled_start_ts"],
            {"asset_type": ASSET_TYPES},
        ),
        Declared(
            "raw_users", ["user_id", "signup_ts"], {"acquisition_channel": channels}, unique=["user_id"]
        ),
    ]


STAGING_CHECKS = [
    Declared(
        "stg_playback_events",
        [
            "event_id",
            "session_id",
            "asset_id",
            "event_type",
            "event_at_utc",
            "position_seconds",
            "is_anonymous_view",
        ],
        {"event_ts_source_format": ENCODINGS},
        unique=["event_id"],
        expressions=[EVENT_RANGE],
    ),
    Declared(
        "stg_asset_catalog",
        [
            "asset_key",
            "asset_id",
            "asset_type",
            "is_replay",
            "sport",
            "has_invalid_duration",
            "scheduled_start_at_utc",
        ],
        {"sport": SPORT_NAMES},
        unique=["asset_key"],
        unique_together=[["asset_id", "title", "asset_type"]],
    ),
    Declared(
        "stg_subscriptions",
        [
            "subscription_change_key",
            "subscription_id",
            "user_id",
            "status",
            "plan_type",
            "effective_at_utc",
            "currency",
            "billing_period_amount",
            "usd_billing_period_amount",
            "billing_period_months",
        ],
        {"billing_period_months": [0, 1, 12]},
        unique=["subscription_change_key"],
        unique_together=[["subscription_id", "effective_at_utc"]],
    ),
    Declared(
        "stg_users",
        ["user_id", "signup_at_utc", "home_state", "acquisition_channel"],
        unique=["user_id"],
        expressions=[STATE_SHAPE],
    ),
]

SEED_CHECKS = [
    Declared(
        "fx_rates",
        ["currency", "rate_to_usd", "valid_from", "valid_to"],
        unique_together=[["currency", "valid_from"]],
    )
]

DATA_CHECKS = [
    Declared(
        "dim_asset",
        ["asset_id", "has_ambiguous_identity", "source_row_count", "sport"],
        {"sport": SPORT_NAMES},
        unique=["asset_id"],
    ),
    Declared(
        "fct_session",
        [
            "session_id",
            "asset_id",
            "completion_pct",
            "watch_minutes",
            "has_unknown_user",
            "is_anonymous_session",
        ],
        unique=["session_id"],
        relationships=[("asset_id", "dim_asset", "asset_id")],
    ),
    Declared(
        "dim_subscription_history",
        [
            "subscription_change_key",
            "subscription_id",
            "user_id",
            "valid_from",
            "valid_to",
            "is_current_state",
            "monthly_amount",
            "usd_monthly_amount",
        ],
        {"billing_period_months": [0, 1, 12]},
        unique=["subscription_change_key"],
        relationships=[("user_id", "stg_users", "user_id")],
    ),
    Declared(
        "fct_user_paid_spells",
        ["paid_spell_key", "user_id", "paid_from", "paid_to", "subscriptions_in_spell", "is_open_ended"],
        unique=["paid_spell_key"],
    ),
    Declared(
        "dim_user",
        [
            "user_id",
            "subscription_count",
            "has_subscription",
            "has_ever_paid",
            "has_ever_churned",
            "is_currently_subscribed",
            "current_usd_mrr",
            "total_paid_days",
            "home_state",
            "acquisition_channel",
        ],
        unique=["user_id"],
    ),
]

PRODUCT_CHECKS = [
    Declared(
        "fct_session_engagement",
        ["session_id", "completion_pct", "is_engaged_view", "engagement_tier"],
        {"engagement_tier": ["abandoned", "sampled", "engaged"]},
        unique=["session_id"],
        relationships=[("session_id", "fct_session", "session_id")],
    ),
    Declared(
        "fct_user_engagement",
        [
            "user_id",
            "is_engaged_user",
            "engagement_tier",
            "session_count",
            "engaged_session_count",
            "total_watch_minutes",
            "has_ever_paid",
            "has_ever_churned",
            "is_currently_subscribed",
            "has_churned_from_paid",
            "current_usd_mrr",
            "total_paid_days",
        ],
        {"engagement_tier": ["never_watched", "abandoned", "sampled", "engaged"]},
        unique=["user_id"],
        relationships=[("user_id", "dim_user", "user_id")],
    ),
]
