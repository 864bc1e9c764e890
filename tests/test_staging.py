from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from subpulse.functions import expressions as X
from subpulse.operators import quality
from subpulse.operators.relational import first_per_key, most_frequent
from subpulse.plans.staging import quarantine_events, stage_events, stage_subscribers
from subpulse.sources.readers import registered_schema

NOW = "2024-01-24 00:00:00"


def subscriber(**values):
    base = dict(subscriber_id="s", email_domain="edu", plan_type="bundle_all", subscription_start_date="2024-01-01",
                subscription_end_date=None, is_churned=False, acquisition_channel="email", country="US",
                device_primary="mobile", created_at="2024-01-01T00:00:00")
    return {**base, **values}


def subscribers(spark, *rows):
    schema = registered_schema("subscribers")
    for field in schema.fields:
        field.nullable = True
    return spark.createDataFrame([tuple(subscriber(**r).values()) for r in rows], schema)


def test_first_written_row_wins(spark):
    raw = subscribers(spark,
                      dict(subscriber_id="a", created_at="2024-02-01T00:00:00", plan_type="bundle_3"),
                      dict(subscriber_id="a", created_at="2024-01-01T00:00:00", plan_type="news_only"),
                      dict(subscriber_id="b", created_at=None, plan_type="games_only"),
                      dict(subscriber_id="b", created_at="2020-01-01T00:00:00"))
    plans = {r.subscriber_id: r.plan_type for r in stage_subscribers(raw, NOW).collect()}
    assert plans == {"a": "news_only", "b": "games_only"}


def test_ties_do_not_depend_on_the_partitioning(spark):
    raw = subscribers(spark, *[dict(subscriber_id="a", country=c) for c in ("US", "GB", "IN", "CA", "AU")])
    picks = {first_per_key(raw.repartition(n), ["subscriber_id"], ["created_at"]).first().country for n in (1, 2, 5)}
    assert picks == {"AU"}


@pytest.mark.parametrize("plan, flags, tier", [
    ("bundle_all", [1, 1, 1, 1, 1], "full_bundle"), ("bundle_3", [1, 1, 1, 0, 0], "partial_bundle"),
    ("news_only", [1, 0, 0, 0, 0], "single_product"), ("athletic_only", [0, 0, 0, 1, 0], "single_product"),
    ("audio_only", [0, 0, 0, 0, 0], "single_product"), (None, [0, 0, 0, 0, 0], "single_product")])
def test_access_and_tier(spark, plan, flags, tier):
    row = stage_subscribers(subscribers(spark, dict(plan_type=plan)), NOW).first()
    got = [row[f"has_{p}_access"] for p in ("news", "games", "cooking", "athletic", "wirecutter")]
    assert (got, row.bundle_tier) == ([bool(f) for f in flags], tier)


def test_dates_and_tenure(spark):
    raw = subscribers(spark, dict(subscriber_id="open"), dict(subscriber_id="ended", subscription_end_date="2024-01-08"),
                      dict(subscriber_id="bad", subscription_start_date="soon", created_at="not-a-date"))
    rows = {r.subscriber_id: r for r in stage_subscribers(raw, NOW).collect()}
    assert rows["open"].tenure_days == 23 and rows["open"].subscription_start_date == date(2024, 1, 1)
    assert rows["ended"].tenure_days == 7
    assert rows["bad"].tenure_days is None and rows["bad"].created_at is None


def events(spark, *rows):
    return spark.createDataFrame(
        rows, "event_id string, subscriber_id string, event_type string, time_on_page_sec double, event_timestamp string")


def test_event_cleaning(spark):
    raw = events(spark, ("1", "s", "article_view", 5000.0, "2024-01-23T10:00:00"),
                 ("2", "s", "article_view", None, "2024-01-25 08:00:00"),
                 ("3", None, "share", 10.0, "2024-01-20T00:00:00"),
                 ("4", "s", "share", 1800.0, "garbage"))
    staged = {r.event_id: r for r in stage_events(raw, NOW).collect()}
    assert set(staged) == {"1", "2", "4"}
    assert staged["1"].time_on_page_sec == 1800.0 and not staged["1"].has_future_timestamp
    # a missing dwell stays missing; the date follows the reported time, the clean time is clamped
    assert staged["2"].time_on_page_sec is None and staged["2"].is_missing_dwell_time
    assert staged["2"].event_date == date(2024, 1, 25) and staged["2"].event_timestamp_clean == datetime(2024, 1, 24)
    assert staged["4"].event_timestamp is None and staged["4"].has_future_timestamp is None
    assert [r.event_id for r in quarantine_events(raw, NOW).collect()] == ["3"]


def test_lag_buckets_are_right_closed(spark):
    hours = [None, -1.0, 0.0, 0.001, 0.5, 0.50001, 2.0, 6.0, 12.0, 12.5]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(hours)], "i int, h double")
    got = [r.b for r in df.select("i", X.lag_bucket(F.col("h")).alias("b")).orderBy("i").collect()]
    assert got == [None, None, None, "<30min", "<30min", "30min-2h", "30min-2h", "2-6h", "6-12h", ">12h"]


@pytest.mark.parametrize("score, label", [(0.95, "PASS"), (0.9499999, "WARN"), (0.85, "WARN"), (0.8499, "FAIL")])
def test_score_labels(spark, score, label):
    assert spark.range(1).select(X.score_label(F.lit(score))).first()[0] == label
    assert spark.range(1).selectExpr(quality._label(f"{score}D")).first()[0] == label


@pytest.mark.parametrize("idle, tier, products, risk", [
    (30, "single_product", 0, "high"), (30, "partial_bundle", 2, "high"), (30, "full_bundle", 0, "low"),
    (30, "full_bundle", 1, "medium"), (29, "single_product", 2, "medium"), (14, "full_bundle", 3, "medium"),
    (13, "full_bundle", 1, "medium"), (13, "single_product", 1, "low"), (-3, "partial_bundle", 2, "low")])
def test_churn_rules(spark, idle, tier, products, risk):
    got = spark.range(1).select(X.churn_risk_tier(F.lit(idle), F.lit(tier), F.lit(products))).first()[0]
    assert got == risk


def test_most_frequent_orders_ties_by_value(spark):
    df = spark.createDataFrame([(v,) for v in "bbaaccd"], "v string")
    assert [tuple(r) for r in most_frequent(df, "v", 3).collect()] == [("a", 2), ("b", 2), ("c", 2)]


def test_clock_default_needs_no_as_of(spark):
    row = stage_subscribers(subscribers(spark, {}), None).first()
    assert row.tenure_days > 0
