"""Daily active subscribers: one metric, at detail grain and across products.

Activity is made distinct per subscriber, day and grain before it meets the
dimension, so a subscriber (or NULL) that owns a large share of the events costs
a few rows per day, and every distinct count becomes a plain count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subpulse import rules
from subpulse.functions import expressions as X
from subpulse.plans.staging import stage_subscribers
from subpulse.sources.tables import Tables, per_product

DETAIL = ["event_date", "product", "platform", "bundle_tier", "country"]
COUNTS = ["daily_active_subscribers"] + [f"daily_active_{t}" for t in rules.TIERS]
COLUMNS = [*DETAIL, *COUNTS, "_model_updated_at", "_metric_version"]


def _qualifies(product: str) -> Column:
    event_type, _, dwell = rules.QUALIFYING[product]
    test = F.col("event_type") == event_type
    return test if dwell is None else test & (F.col("time_on_page_sec") > dwell)


def qualifying_activity(events: DataFrame, as_of: X.AsOf = None, lookback_days: int | None = rules.LOOKBACK_DAYS,
                        since: Column | None = None, drop_orphans: tuple[str, ...] = ("news",)) -> DataFrame:
    """Events that make a subscriber active, from ``lookback_days`` before ``as_of`` on.

    Without ``lookback_days`` all dates count. ``since`` adds an inclusive lower
    bound on the date. News drops events
    without a subscriber; the other products keep them as their own groups.
    """
    ts = X.parsed_ts(events, "event_timestamp")
    keep = F.lit(False)
    for product in rules.QUALIFYING:
        test = (F.col("product") == product) & _qualifies(product)
        if product in drop_orphans:
            test = test & F.col("subscriber_id").isNotNull()
        keep = keep | test
    rows = events.filter(keep)
    if lookback_days is not None:
        rows = rows.filter(X.on_or_after(ts, X.lookback_start(as_of, lookback_days)))
    if since is not None:
        rows = rows.filter(X.on_or_after(ts, since))
    label = per_product({p: F.lit(rule[1]) for p, rule in rules.QUALIFYING.items()})
    return rows.select(
        ts.cast("date").alias("event_date"), "subscriber_id", "product", "platform",
        label.alias("qualifying_event"),
    )


def enriched_activity(activity: DataFrame, subscribers: DataFrame) -> DataFrame:
    """Qualifying activity with the subscriber's plan, tier, country and channel.

    The join key is a struct: ``subscribers`` is often partitioned by the bare id
    already, and AQE splits a hot key only if both sides are shuffled for the
    join itself. Its second field spreads activity without a subscriber.
    """
    own = ["plan_type", "bundle_tier", "country", "acquisition_channel"]
    dims = subscribers.select(F.struct("subscriber_id", F.lit(0).cast("long").alias("spread")).alias("_key"), *own)
    spread = F.when(F.col("subscriber_id").isNull(), F.xxhash64("event_date", "product", "platform")).otherwise(F.lit(0))
    keyed = activity.withColumn("_key", F.struct("subscriber_id", spread.alias("spread")))
    return keyed.join(dims, "_key", "left").drop("_key")


def _tier_counts(counted: Column) -> list[Column]:
    """Counts of the rows that carry a subscriber, overall and per tier."""
    return [F.count_if(counted).alias(COUNTS[0])] + [
        F.count_if(counted & (F.col("bundle_tier") == tier)).alias(f"daily_active_{tier}") for tier in rules.TIERS
    ]


def _stamped(df: DataFrame, as_of: X.AsOf) -> DataFrame:
    return df.select(*DETAIL, *COUNTS, X.as_of_ts(as_of).alias("_model_updated_at"),
                     F.lit(rules.METRIC_VERSION).alias("_metric_version"))


def metric_of(activity: DataFrame, subscribers: DataFrame, as_of: X.AsOf = None) -> DataFrame:
    """The metric over qualifying activity.

    1. every event stands for its own product and platform, and for the day's total;
    2. each subscriber counts once per day and grain: duplicates go on the map side;
    3. the dimension joins what is left, a few rows per subscriber and day;
    4. counting rows is then counting subscribers.
    """
    total = F.struct(F.lit(rules.ALL_PRODUCTS).alias("product"), F.lit(None).cast("string").alias("platform"))
    active = (activity.select("event_date", "subscriber_id",
                              F.inline(F.array(F.struct("product", "platform"), total))).distinct())
    return _counted(active, subscribers, as_of)


def _counted(active: DataFrame, subscribers: DataFrame, as_of: X.AsOf) -> DataFrame:
    """The metric over activity that is distinct per (event_date, product, platform, subscriber_id), totals included."""
    dims = subscribers.select("subscriber_id", "bundle_tier", "country")
    rows = active.join(dims, "subscriber_id", "left")
    # a total's group has neither tier nor country, its counts still need the tier
    is_detail = F.col("product") != rules.ALL_PRODUCTS
    counted = (rows.withColumns({"group_tier": F.when(is_detail, F.col("bundle_tier")),
                                 "country": F.when(is_detail, F.col("country"))})
               .groupBy("event_date", "product", "platform", "group_tier", "country")
               .agg(*_tier_counts(F.col("subscriber_id").isNotNull()))
               .withColumnRenamed("group_tier", "bundle_tier"))
    return _stamped(counted, as_of)


def daily_active(tables: Tables, as_of: X.AsOf = None, lookback_days: int | None = rules.LOOKBACK_DAYS,
                 since: Column | None = None, subscribers: DataFrame | None = None) -> DataFrame:
    """Detail rows plus one ALL_PRODUCTS row per date."""
    staged = subscribers if subscribers is not None else stage_subscribers(tables.subscribers, as_of)
    return metric_of(qualifying_activity(tables.events, as_of, lookback_days, since), staged, as_of)


def daily_active_grouping_sets(tables: Tables, as_of: X.AsOf = None,
                               lookback_days: int = rules.LOOKBACK_DAYS) -> DataFrame:
    """The same metric with GROUPING SETS: one Expand makes activity distinct at both grains, the rest counts rows.

    Totals are told from missing products by ``grouping()``, not by NULLs.
    """
    activity = qualifying_activity(tables.events, as_of, lookback_days)
    detail = ["event_date", "product", "platform", "subscriber_id"]
    grains = activity.groupingSets([detail, ["event_date", "subscriber_id"]], *detail).agg(
        F.grouping("product").alias("is_total"))
    active = grains.withColumn("product", F.when(F.col("is_total") == 1, rules.ALL_PRODUCTS).otherwise(
        F.col("product"))).drop("is_total")
    return _counted(active, stage_subscribers(tables.subscribers, as_of), as_of)
