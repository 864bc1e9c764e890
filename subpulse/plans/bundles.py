"""Bundle and churn metrics that finance reads next to the daily metric.

The definitions are this project's own: activity by plan and week, rolling
churn by plan, lifetime value by tier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subpulse import rules
from subpulse.functions import expressions as X


def bundle_metrics(events: DataFrame, staged: DataFrame, as_of: X.AsOf = None,
                   lookback_days: int = rules.LOOKBACK_DAYS) -> DataFrame:
    """Per plan and week: active subscribers, events and revenue of the active subscribers.

    Events are counted per subscriber and week before the join.
    """
    ts = X.parsed_ts(events, "event_timestamp")
    rows = events.filter(X.on_or_after(ts, X.lookback_start(as_of, lookback_days))
                         & F.col("subscriber_id").isNotNull())
    weekly = rows.groupBy("subscriber_id", F.date_trunc("week", ts).cast("date").alias("week_start")).agg(
        F.count(F.lit(1)).alias("n"))
    dims = staged.select("subscriber_id", "plan_type", "bundle_tier")
    return weekly.join(dims, "subscriber_id").groupBy("plan_type", "week_start").agg(
        F.count(F.lit(1)).alias("active_subscribers"), F.sum("n").alias("events"),
        F.sum(X.mrr_of_tier(F.col("bundle_tier"))).alias("mrr_usd"))


def churn_rate(staged: DataFrame, as_of: X.AsOf = None, window_days: int = 90) -> DataFrame:
    """Per plan: subscribers active at the window start, those who ended inside it, and the rate."""
    start, end = X.lookback_start(as_of, window_days), X.as_of_date(as_of)
    began, ended = F.col("subscription_start_date"), F.col("subscription_end_date")
    at_start = (began < start) & (ended.isNull() | (ended >= start))
    lost = at_start & (ended <= end)
    return staged.groupBy("plan_type").agg(
        F.count_if(at_start).alias("active_at_start"), F.count_if(lost).alias("churned")).withColumn(
        "churn_pct", F.round(X.ratio(F.col("churned"), F.col("active_at_start")) * 100, 2))


def bundle_ltv(staged: DataFrame) -> DataFrame:
    """Per tier: subscribers, mean tenure in days, monthly revenue, and revenue over that tenure."""
    return (staged.groupBy("bundle_tier").agg(
        F.count(F.lit(1)).alias("subscribers"), F.round(F.avg("tenure_days"), 6).alias("avg_tenure_days"))
        .withColumn("mrr_usd", X.mrr_of_tier(F.col("bundle_tier")))
        .withColumn("ltv_usd", F.round(F.col("mrr_usd") * F.col("avg_tenure_days") / F.lit(30.0), 2)))
