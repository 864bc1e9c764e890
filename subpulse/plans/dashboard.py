"""Dashboard aggregates over the raw tables."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subpulse import rules
from subpulse.functions import expressions as X
from subpulse.operators.relational import group_rate, trailing_days, value_counts
from subpulse.sources.tables import Tables


def _rows() -> Column:
    return F.count(F.lit(1))


def plan_distribution(subscribers: DataFrame) -> DataFrame:
    return value_counts(subscribers, "plan_type", name="subscribers")


def acquisition_distribution(subscribers: DataFrame) -> DataFrame:
    return value_counts(subscribers, "acquisition_channel", name="subscribers")


def tier_distribution(subscribers: DataFrame) -> DataFrame:
    return value_counts(subscribers.select(X.tier_label(F.col("plan_type")).alias("tier")), "tier", name="subscribers")


def churn_by_plan(subscribers: DataFrame) -> DataFrame:
    """Churned subscribers and churn rate per plan, in percent with one decimal."""
    return group_rate(subscribers, "plan_type", F.col("is_churned")).select(
        "plan_type", F.col("flagged").alias("churned"), "rate")


def _dated(events: DataFrame) -> DataFrame:
    return events.withColumn("event_date", X.parsed_ts(events, "event_timestamp").cast("date"))


def weekly_active(events: DataFrame) -> DataFrame:
    """Distinct subscribers per product from 7 days before the newest news or games date on."""
    dated = _dated(events)
    newest = dated.filter(F.col("product").isin("news", "games")).agg(F.max("event_date").alias("newest"))
    return (trailing_days(dated, "event_date", newest, 7).groupBy("product")
            .agg(F.count_distinct("subscriber_id").alias("active_subscribers")))


def game_completions(games: DataFrame) -> DataFrame:
    return value_counts(games.filter(F.col("event_type") == "game_complete"), "game_name", name="completions")


def daily_readers(news: DataFrame) -> DataFrame:
    """Distinct readers per date, from 30 days before the newest date on."""
    dated = _dated(news)
    newest = dated.agg(F.max("event_date").alias("newest"))
    return (trailing_days(dated, "event_date", newest, 30).groupBy("event_date")
            .agg(F.count_distinct("subscriber_id").alias("readers")))


def _used_products(events: DataFrame) -> DataFrame:
    """One row per subscriber with a flag per product."""
    return events.filter(F.col("subscriber_id").isNotNull()).groupBy("subscriber_id").agg(
        *[F.bool_or(F.col("product") == p).alias(p) for p in rules.PRODUCTS])


def _used(products: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(p).cast("int") for p in products])


def multi_product(events: DataFrame) -> DataFrame:
    """Overlap as the dashboard defines it. The rows do not partition the subscribers:
    "2 Products" looks at news, games and cooking only, "3 Products" needs exactly those three."""
    three = ("news", "games", "cooking")
    all_three = reduce(and_, [F.col(p) for p in three])
    counts = _used_products(events).agg(
        F.count_if(_used(rules.PRODUCTS) == 1).alias("one"),
        F.count_if(_used(three) == 2).alias("two"),
        F.count_if(all_three & ~F.col("athletic")).alias("three"),
        F.count_if(all_three & F.col("athletic")).alias("four"))
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(label).alias("bucket"), F.col(name).alias("subscribers"))
        for label, name in (("1 Product", "one"), ("2 Products", "two"), ("3 Products", "three"), ("4 Products", "four"))
    ])))


def product_breadth(events: DataFrame) -> DataFrame:
    """Subscribers by the number of products used: each subscriber counts once."""
    return _used_products(events).groupBy(_used(rules.PRODUCTS).alias("products")).agg(_rows().alias("subscribers"))


def _tenure(as_of: X.AsOf) -> Column:
    return X.tenure_to_date(F.col("subscription_start_date").try_cast("date"), X.as_of_date(as_of))


def risk_buckets(subscribers: DataFrame, as_of: X.AsOf = None) -> DataFrame:
    risk = X.simple_risk(F.col("is_churned"), _tenure(as_of), F.col("plan_type"))
    return value_counts(subscribers.select(risk.alias("risk")), "risk", name="subscribers")


def section_readers(news: DataFrame) -> DataFrame:
    """Distinct readers per section, most read first."""
    return (news.dropna(subset=["section"]).groupBy("section")
            .agg(F.count_distinct("subscriber_id").alias("readers")).orderBy(F.desc("readers"), "section"))


def kpis(tables: Tables, as_of: X.AsOf = None) -> DataFrame:
    """One row of headline numbers; tenure and revenue cover active subscribers only."""
    active = ~F.col("is_churned")
    plan = F.col("plan_type")
    bundled = F.coalesce(plan.isin(rules.BUNDLE_PLANS), F.lit(False))
    subs = tables.subscribers.agg(
        _rows().alias("total_subs"),
        F.count_if("is_churned").alias("churned"),
        F.round(F.avg(F.when(active, _tenure(as_of))), 1).alias("avg_tenure"),
        F.round(F.avg(bundled.cast("double")) * 100, 1).alias("bundle_pct"),
        F.round(F.sum(F.when(active, X.mrr_of_tier(X.bundle_tier(plan)))), 0).alias("mrr_estimate"))
    return subs.withColumn("total_events", tables.events.agg(_rows()).scalar())
