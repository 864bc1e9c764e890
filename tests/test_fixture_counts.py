"""Counts written down for sf0.01 when the input mapping was designed."""

import pytest
from conftest import MEDIUM, SMALL
from pyspark.sql import functions as F

from subpulse import rules
from subpulse.operators import late
from subpulse.plans import dashboard
from subpulse.plans.daily_active import daily_active, daily_active_grouping_sets
from subpulse.plans.health import subscriber_health
from subpulse.queries import AS_OF
from subpulse.sources import from_driver_tables


def counted(df, *by):
    return {tuple(r)[:-1] if len(by) > 1 else r[0]: r[-1] for r in df.groupBy(*by).count().collect()}


def test_raw_tables(tables):
    subs = tables.subscribers
    assert (subs.count(), subs.select("subscriber_id").distinct().count()) == (1515, 1500)
    assert subs.filter("plan_type IS NULL").count() == 5
    assert subs.filter(F.col("plan_type").isin(rules.REGISTERED_PLANS)).count() == 1495
    assert subs.filter(F.col("plan_type").isin(rules.KNOWN_PLANS)).count() == 1502
    assert counted(tables.events, "product") == {"news": 3731, "games": 2220, "cooking": 1774, "athletic": 2275}


@pytest.mark.parametrize("sf", [SMALL, MEDIUM, "/root/testdata/sf0.1"])
def test_every_event_is_kept(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    kept = from_driver_tables(spark, sf).events
    assert kept.count() == events.count() and kept.select("event_id").exceptAll(events.select("event_id")).isEmpty()


def test_metric_rows(tables):
    metric = daily_active(tables, AS_OF).cache()
    assert metric.count() == 1998
    assert metric.filter("product = 'ALL_PRODUCTS'").count() == 30
    assert metric.filter("product <> 'ALL_PRODUCTS' AND bundle_tier IS NULL").count() == 37
    assert metric.filter("daily_active_subscribers = 0").count() == 9
    other = daily_active_grouping_sets(tables, AS_OF)
    assert metric.exceptAll(other).count() == 0 and other.exceptAll(metric).count() == 0
    # the total never exceeds the sum over products, platforms and countries
    per_day = metric.groupBy("event_date").agg(
        F.sum(F.when(F.col("product") == "ALL_PRODUCTS", F.col("daily_active_subscribers"))).alias("total"),
        F.sum(F.when(F.col("product") != "ALL_PRODUCTS", F.col("daily_active_subscribers"))).alias("parts"))
    assert per_day.filter("total > parts").count() == 0
    metric.unpersist()


def test_lookback_bites(tables):
    assert daily_active(tables, AS_OF, 14).count() == 1392


def test_risk_branches(tables):
    seen = counted(subscriber_health(tables, AS_OF), "bundle_tier", "churn_risk_tier")
    assert seen == {
        ("single_product", "high"): 780, ("single_product", "low"): 68, ("single_product", "medium"): 17,
        ("partial_bundle", "high"): 189, ("partial_bundle", "low"): 16, ("partial_bundle", "medium"): 6,
        ("full_bundle", "low"): 411, ("full_bundle", "medium"): 13}


def test_lateness(tables):
    lagged = late.with_lag(tables.events)
    shares = {r.domain: r.late_pct for r in late.late_shares(lagged).collect()}
    assert shares == {"events_news": 32.48, "events_games": 18.11, "events_cooking": 2.76, "events_athletic": 24.40}
    flagged = counted(late.late_days(lagged).filter("needs_reprocessing"), "domain")
    assert flagged == {"events_news": 20, "events_games": 20, "events_cooking": 3, "events_athletic": 20}
    buckets = counted(lagged, "lag_bucket")
    assert buckets == {"<30min": 5661, "30min-2h": 815, "2-6h": 1549, "6-12h": 764, ">12h": 377, None: 834}


def test_overlap(tables):
    assert [r.subscribers for r in dashboard.multi_product(tables.events).collect()] == [15, 17, 0, 119]
    breadth = {r.products: r.subscribers for r in dashboard.product_breadth(tables.events).collect()}
    assert breadth == {1: 15, 2: 15, 3: 2, 4: 119}
