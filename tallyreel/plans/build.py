"""The whole pipeline: lazily composed tables, or written marts."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyreel.config import EngineConfig
from tallyreel.plans import marts_data, marts_product, staging
from tallyreel.plans.descriptions import COLUMNS, TABLES
from tallyreel.profiling.shared import stacked
from tallyreel.quality import checks as Q
from tallyreel.quality import declared as D
from tallyreel.quality.suite import failing_count, run_declared
from tallyreel.session import size_shuffles
from tallyreel.sources.publish import publish, write_version
from tallyreel.sources.raw import RawTables
from tallyreel.sources.sinks import (
    DATA_NAMESPACE,
    PRODUCT_NAMESPACE,
    STAGING_NAMESPACE,
    with_comments,
)


class Models:
    """Every table as a lazy DataFrame over the landed raw tables."""

    def __init__(self, raw: RawTables, config: EngineConfig) -> None:
        self.raw = raw
        self.config = config

    @cached_property
    def stg_playback_events(self) -> DataFrame:
        return staging.stg_playback_events(self.raw["playback_events"])

    @cached_property
    def ordered_events(self) -> DataFrame:
        return staging.ordered_events(self.raw["playback_events"])

    @cached_property
    def stg_asset_catalog(self) -> DataFrame:
        return staging.stg_asset_catalog(self.raw["asset_catalog"])

    @cached_property
    def stg_subscriptions(self) -> DataFrame:
        return staging.stg_subscriptions(self.raw["subscriptions"], self.raw.rates, self.raw.many_rate_periods)

    @cached_property
    def stg_users(self) -> DataFrame:
        return staging.stg_users(self.raw["users"])

    @cached_property
    def dim_asset(self) -> DataFrame:
        return marts_data.dim_asset(self.stg_asset_catalog)

    @cached_property
    def dim_subscription_history(self) -> DataFrame:
        hot = self.raw.hot("subscriptions", "subscription_id", "bigint")
        return marts_data.dim_subscription_history(
            self.stg_subscriptions, self.stg_users, self.config, hot
        )

    @cached_property
    def fct_user_paid_spells(self) -> DataFrame:
        hot = self.raw.hot("subscriptions", "user_id", "bigint")
        return marts_data.fct_user_paid_spells(self.dim_subscription_history, self.config, hot)

    @cached_property
    def fct_session(self) -> DataFrame:
        return marts_data.fct_session(self.stg_playback_events, self.dim_asset, self.stg_users)

    @cached_property
    def dim_user(self) -> DataFrame:
        return marts_data.dim_user(
            self.stg_users, self.dim_subscription_history, self.fct_user_paid_spells
        )

    @cached_property
    def fct_session_engagement(self) -> DataFrame:
        return marts_product.fct_session_engagement(self.fct_session, self.config)

    @cached_property
    def fct_user_engagement(self) -> DataFrame:
        return marts_product.fct_user_engagement(self.dim_user, self.fct_session, self.config)


STAGING = ["stg_playback_events", "stg_asset_catalog", "stg_subscriptions", "stg_users"]
DATA_MARTS = ["dim_asset", "dim_subscription_history", "fct_user_paid_spells", "fct_session", "dim_user"]
PRODUCT_MARTS = ["fct_session_engagement", "fct_user_engagement"]
# Tables that grow by the day are laid out by day, so that a date filter reads its days only.
PARTITIONS = {"fct_session": "session_date", "fct_session_engagement": "session_date"}
# Tables that later ones window, aggregate or join by this column, which then need no exchange. The
# landed table and the type name the groups that must not be too big for one bucket.
BUCKETS = {
    "stg_playback_events": ("session_id", "playback_events", "string"),
    "dim_subscription_history": ("user_id", "subscriptions", "bigint"),
    "fct_user_paid_spells": ("user_id", "subscriptions", "bigint"),
    "dim_user": ("user_id", "subscriptions", "bigint"),
}


class ChecksFailed(Exception):
    """Raised by a checked build; names the checks that some rows fail."""


def table_of(models: Models) -> Callable[[str], DataFrame]:
    """Tables by the names that declared checks use."""

    def get(name: str) -> DataFrame:
        if name == "fx_rates":
            return models.raw.rates
        return models.raw[name.removeprefix("raw_")] if name.startswith("raw_") else getattr(models, name)

    return get


def staging_asserts(models: Models) -> dict[str, DataFrame]:
    """Failing rows of the whole-table checks on landed and staged rows."""
    raw = models.raw
    return {
        "assert_collapse_columns_agree": Q.assert_collapse_columns_agree(models.stg_asset_catalog),
        "assert_duplicates_identical": Q.assert_duplicates_identical(raw["playback_events"]),
        "assert_row_reconciliation": Q.assert_row_reconciliation(raw["playback_events"], models.stg_playback_events),
        "assert_rowcount_equal": Q.assert_rowcount_equal(
            {
                "stg_asset_catalog": (raw["asset_catalog"], models.stg_asset_catalog),
                "stg_users": (raw["users"], models.stg_users),
                "stg_subscriptions": (raw["subscriptions"], models.stg_subscriptions),
            }
        ),
    }


def data_asserts(models: Models) -> dict[str, DataFrame]:
    hot_subscriptions = models.raw.hot("subscriptions", "subscription_id", "bigint")
    hot_users = models.raw.hot("subscriptions", "user_id", "bigint")
    return {
        "assert_exclusions_reconcile": Q.assert_exclusions_reconcile(
            models.stg_playback_events, models.dim_asset, models.fct_session
        ),
        "assert_windows_contiguous": Q.assert_windows_contiguous(models.dim_subscription_history, hot_subscriptions),
        "assert_intervals_no_overlap": Q.assert_intervals_no_overlap(
            models.fct_user_paid_spells, "user_id", "paid_from", "paid_to", "spell_number", hot_users
        ),
    }


def product_asserts(models: Models) -> dict[str, DataFrame]:
    return {"assert_spine_grain": Q.assert_spine_grain(models.fct_user_engagement, models.stg_users, models.fct_session)}


ASSERTS = {STAGING_NAMESPACE: staging_asserts, DATA_NAMESPACE: data_asserts, PRODUCT_NAMESPACE: product_asserts}
SUITES = {
    STAGING_NAMESPACE: [*D.source_checks(), *D.STAGING_CHECKS, *D.SEED_CHECKS],
    DATA_NAMESPACE: D.DATA_CHECKS,
    PRODUCT_NAMESPACE: D.PRODUCT_CHECKS,
}


def layer_report(models: Models, layer: str, suite: list[D.Declared] | None = None) -> DataFrame:
    """(check_name, failing_rows) of every check of one layer."""
    declared = run_declared(table_of(models), SUITES[layer] if suite is None else suite)
    return stacked([declared, *(failing_count(name, rows) for name, rows in ASSERTS[layer](models).items())])


def require_passing(report: DataFrame) -> None:
    """Raises with the names and counts of the failed checks; the report has one row a check."""
    failed = report.filter(F.col("failing_rows") > 0).orderBy("check_name").collect()
    if failed:
        raise ChecksFailed("; ".join(f"{r['check_name']}: {r['failing_rows']}" for r in failed))


def build(
    raw: RawTables,
    config: EngineConfig,
    path: str | None = None,
    check: bool = False,
    suites: dict[str, list[D.Declared]] | None = None,
) -> Models:
    """Write every mart in dependency order; each later one reads the written ones.

    A layer is written whole before its tables are published. With ``check`` the layer's declared and
    whole-table checks run on the written tables first, and a failing row stops the build before anybody
    reads or builds on them. ``suites`` replaces the declared checks of a layer.

    The cleaned events are not a mart, but sessions, checks and the ordered profiles all read
    them, so they are written too, bucketed by session unless some session is too big for one
    bucket. The tables of users are bucketed by user in the same way. Staging views of small
    sources stay lazy.
    """
    models = Models(raw, config)
    spark = raw["playback_events"].sparkSession
    size_shuffles(spark, raw.tables.values())
    for namespace, names in (
        (STAGING_NAMESPACE, ["stg_playback_events"]),
        (DATA_NAMESPACE, DATA_MARTS),
        (PRODUCT_NAMESPACE, PRODUCT_MARTS),
    ):
        folder = None if path is None else f"{path}/{namespace}"
        versions = []
        for name in names:
            described = with_comments(getattr(models, name), COLUMNS.get(name, {}))
            by, source, kind = BUCKETS.get(name, (None, None, None))
            by = None if by is None or raw.hot(source, by, kind) else by
            versions.append(write_version(described, namespace, name, folder, PARTITIONS.get(name), by))
            setattr(models, name, versions[-1].read(spark))
        if check:
            require_passing(layer_report(models, namespace, (suites or {}).get(namespace)))
        for version in versions:
            publish(spark, version, TABLES[version.table])
    return models
