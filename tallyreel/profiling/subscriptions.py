"""Subscriptions: lifecycles, amounts, concurrency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyreel.functions.numeric import round_half_away
from tallyreel.functions.timestamps import parse_naive
from tallyreel.operators.intervals import containing_pairs, overlap_partners
from tallyreel.operators.paths import counted_paths
from tallyreel.operators.split_window import HotGroups
from tallyreel.plans.marts_data import ENDED_STATES, PAID_PLANS
from tallyreel.profiling.shared import row_count, stacked, top


def rows_per_entity(subscriptions: DataFrame) -> DataFrame:
    def spread(label: str, per_entity: DataFrame) -> DataFrame:
        return per_entity.agg(
            F.min("n").alias("min"),
            F.max("n").alias("max"),
            round_half_away(F.avg("n"), 2).alias("avg"),
            row_count().alias("n_entities"),
        ).select(F.lit(label).alias("metric"), "min", "max", "avg", "n_entities")

    per_sub = subscriptions.groupBy("subscription_id").agg(row_count().alias("n"))
    per_user = subscriptions.groupBy("user_id").agg(F.count_distinct("subscription_id").alias("n"))
    # Metric labels.
    return stacked(
        [spread("rows per subscription_id", per_sub), spread("subscriptions per user_id", per_user)]
    )


def amounts_by(subscriptions: DataFrame, first: str, second: str, names: tuple[str, str, str]) -> DataFrame:
    """Counts and the range of the amount text by two columns."""
    return (
        subscriptions.groupBy(first, second)
        .agg(
            row_count().alias("rows"),
            F.count_distinct("mrr_amount").alias(names[0]),
            F.min("mrr_amount").alias(names[1]),
            F.max("mrr_amount").alias(names[2]),
        )
        .orderBy(first, second)
    )


def smallest_amount(subscriptions: DataFrame) -> DataFrame:
    return (
        subscriptions.groupBy("currency", "plan_type")
        .agg(row_count().alias("rows"), F.min("mrr_amount").alias("amt"))
        .orderBy("currency", "plan_type")
    )


def subs_per_user(subscriptions: DataFrame) -> DataFrame:
    per_user = subscriptions.groupBy("user_id").agg(
        F.count_distinct("subscription_id").alias("subscriptions_held")
    )
    return (
        per_user.groupBy("subscriptions_held").agg(row_count().alias("users")).orderBy("subscriptions_held")
    )


def sample_subscription(subscriptions: DataFrame, rows: int = 3) -> DataFrame:
    """Every row of the first subscription that has a given number of rows."""
    sized = subscriptions.groupBy("subscription_id").agg(row_count().alias("n"))
    chosen = sized.filter(F.col("n") == rows).agg(F.min("subscription_id")).scalar()
    return subscriptions.filter(F.col("subscription_id") == chosen).orderBy("event_effective_ts")


def sample_multi_sub_user(subscriptions: DataFrame, at_least: int = 4) -> DataFrame:
    """Every row of the user with most rows among those holding several subscriptions."""
    chosen = (
        subscriptions.groupBy("user_id")
        .agg(F.count_distinct("subscription_id").alias("held"), row_count().alias("n"))
        .filter(F.col("held") >= at_least)
        .orderBy(F.desc("n"), "user_id")
        .limit(1)
        .select("user_id")
        .scalar()
    )
    return subscriptions.filter(F.col("user_id") == chosen).orderBy("subscription_id", "event_effective_ts")


def status_paths(subscriptions: DataFrame, hot: HotGroups | None = None) -> DataFrame:
    """Ordered status path per subscription, counted."""
    order = ["event_effective_ts", "status"]
    counted = counted_paths(subscriptions, "subscription_id", "status", order, " -> ", "path", "subscriptions", hot)
    return counted.orderBy(F.desc("subscriptions"), "path")


# ------------------------------------------------------------------ concurrency


def _spans(changes: DataFrame, at: Column, flag: Column) -> DataFrame:
    """First and last change per user and subscription; spans without a readable time drop out."""
    return (
        changes.filter(F.col("user_id").isNotNull() & F.col("subscription_id").isNotNull())
        .groupBy("user_id", "subscription_id")
        .agg(F.min(at).alias("first_ts"), F.max(at).alias("last_ts"), flag.alias("flag"))
        .filter(F.col("first_ts").isNotNull())
    )


def _raw_spans(subscriptions: DataFrame) -> DataFrame:
    return _spans(subscriptions, parse_naive(F.col("event_effective_ts")), F.bool_or(F.lit(True)))


def _closed_partners(spans: DataFrame, hot: HotGroups | None) -> DataFrame:
    return overlap_partners(spans, "user_id", "subscription_id", "first_ts", "last_ts", "flag", True, hot)


def overlapping_subs(subscriptions: DataFrame, hot: HotGroups | None) -> DataFrame:
    """Pairs of one user's subscriptions that overlap in time, and the users who have any."""
    partners = F.col("flagged_partners") + F.col("other_partners")
    per_user = (
        _closed_partners(_raw_spans(subscriptions), hot).groupBy("user_id").agg(F.sum(partners).alias("pairs"))
    )
    return per_user.agg(
        F.coalesce(F.sum("pairs"), F.lit(0)).alias("overlapping_pairs"),
        F.count_if(F.col("pairs") > 0).alias("users_with_overlap"),
    )


def overlapping_pairs_list(subscriptions: DataFrame, hot: HotGroups | None, limit: int = 50) -> DataFrame:
    """The first pairs by user, by the span that starts later, then by the one that starts earlier.

    At most ``limit`` later spans can take part, as each brings at least one pair. They are found
    by the sweep, and only their partners are looked up.
    """
    spans = _raw_spans(subscriptions).drop("flag")
    swept = _closed_partners(spans.withColumn("flag", F.lit(True)), hot)
    ident = ["user_id", "subscription_id"]
    starting = spans.join(swept.filter(F.col("flagged_partners") > 0).select(*ident), ident, "left_semi")
    later = top(starting, [F.col("user_id"), F.col("first_ts"), F.col("subscription_id")], limit).alias("l")
    # Never more than ``limit`` rows, hence safe to broadcast.
    e, l = spans.alias("e"), F.broadcast(later)
    started_before = (F.col("e.first_ts") < F.col("l.first_ts")) | (
        (F.col("e.first_ts") == F.col("l.first_ts"))
        & (F.col("e.subscription_id") < F.col("l.subscription_id"))
    )
    pairs = e.join(
        l,
        (F.col("e.user_id") == F.col("l.user_id"))
        & started_before
        & (F.col("e.last_ts") >= F.col("l.first_ts")),
    )
    order = [
        F.col("l.user_id"),
        F.col("l.first_ts"),
        F.col("l.subscription_id"),
        F.col("e.first_ts"),
        F.col("e.subscription_id"),
    ]
    swap = F.col("l.subscription_id") < F.col("e.subscription_id")

    def side(column: str, name: str, first: bool) -> Column:
        a, b = (f"l.{column}", f"e.{column}") if first else (f"e.{column}", f"l.{column}")
        return F.when(swap, F.col(a)).otherwise(F.col(b)).alias(name)

    return pairs.orderBy(*order).limit(limit).select(
        F.col("l.user_id").alias("user_id"),
        side("subscription_id", "sub_a", True),
        side("subscription_id", "sub_b", False),
        side("first_ts", "a_from", True),
        side("last_ts", "a_to", True),
        side("first_ts", "b_from", False),
        side("last_ts", "b_to", False),
    )


def overlap_kind(changes: DataFrame, hot: HotGroups | None) -> DataFrame:
    """Overlapping pairs by whether both, one or neither of the two ever was a paid plan."""
    paid = F.bool_or(F.coalesce(F.col("plan_type").isin(PAID_PLANS), F.lit(False)))
    partners = _closed_partners(_spans(changes, F.col("effective_at_utc"), paid), hot)
    flagged, other = F.col("flagged_partners"), F.col("other_partners")
    # Kind labels.
    kinds = {
        "BOTH PAID (real problem)": F.when(F.col("flag"), flagged).otherwise(0),
        "one paid, one trial-only": F.when(F.col("flag"), other).otherwise(flagged),
        "both trial-only": F.when(F.col("flag"), 0).otherwise(other),
    }
    names = {label: f"pairs{i}" for i, label in enumerate(kinds)}
    per_user = partners.groupBy("user_id").agg(*[F.sum(c).alias(names[k]) for k, c in kinds.items()])
    totals = per_user.agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names.values()],
        *[F.count_if(F.col(n) > 0).alias(f"{n}_users") for n in names.values()],
    )
    rows = [
        F.struct(
            F.lit(label).alias("overlap_kind"),
            F.col(n).alias("overlapping_pairs"),
            F.col(f"{n}_users").alias("users"),
        )
        for label, n in names.items()
    ]
    return (
        totals.select(F.explode(F.array(*rows)).alias("_r"))
        .select("_r.*")
        .filter("overlapping_pairs > 0")
        .orderBy(F.desc("overlapping_pairs"), "overlap_kind")
    )


def concurrent_paid(changes: DataFrame, hot: HotGroups | None) -> DataFrame:
    """Pairs of paid subscriptions active at once, from first activation to first ending.

    A log whose first ending precedes its first activation gives a reversed span. Two reversed
    spans never overlap, and a reversed one overlaps exactly the proper ones that contain it, so
    those are counted block by block while the sweep counts the rest.
    """
    # Fixed value: end of a subscription that never ended.
    never = F.to_timestamp_ntz(F.lit("2099-01-01 00:00:00"))
    at = F.col("effective_at_utc")
    active = (
        changes.filter(F.col("plan_type").isin(PAID_PLANS) & F.col("user_id").isNotNull())
        .groupBy("user_id", "subscription_id")
        .agg(
            F.min(F.when(F.col("status") == "active", at)).alias("active_from"),
            F.coalesce(F.min(F.when(F.col("status").isin(ENDED_STATES), at)), never).alias("active_to"),
        )
        .filter(F.col("active_from").isNotNull())
        .withColumn("flag", F.lit(True))
    )
    proper = active.filter(F.col("active_from") < F.col("active_to"))
    swept = overlap_partners(
        proper, "user_id", "subscription_id", "active_from", "active_to", "flag", False, hot
    ).select("user_id", F.col("flagged_partners").alias("pairs"))
    reversed_spans = active.filter(F.col("active_from") >= F.col("active_to"))
    # A reversed span reaches from its end to its start.
    containing = containing_pairs(
        proper, reversed_spans, "user_id", "subscription_id", ("active_from", "active_to"), ("active_to", "active_from"), hot
    )
    per_user = swept.unionByName(containing).groupBy("user_id").agg(F.sum("pairs").alias("pairs"))
    return per_user.agg(
        F.coalesce(F.sum("pairs"), F.lit(0)).alias("truly_concurrent_paid_pairs"),
        F.count_if(F.col("pairs") > 0).alias("users_affected"),
    )


def rates_in_use(subscriptions: DataFrame, rates: DataFrame) -> DataFrame:
    """The loaded rate table beside the number of changes in each currency."""
    used = subscriptions.groupBy(F.col("currency").alias("_c")).agg(row_count().alias("n"))
    return rates.join(used, F.col("currency") == F.col("_c"), "left").select(
        "currency",
        "rate_to_usd",
        "valid_from",
        "valid_to",
        F.coalesce("n", F.lit(0)).alias("subscription_rows"),
    )
