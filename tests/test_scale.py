"""Plans and results under one subscriber (and NULL) that owns most events."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SMALL
from subpulse.operators.relational import first_per_key, membership_counts
from subpulse.plans.daily_active import (daily_active, daily_active_grouping_sets, enriched_activity,
                                          qualifying_activity)
from subpulse.plans.health import subscriber_health
from subpulse.plans.staging import stage_subscribers
from subpulse.queries import AS_OF
from subpulse.sources import Tables

PLANNED = ["stg_subscribers", "daily_active", "subscriber_health", "dq_report", "dq_scorecard", "drift_events",
           "drift_status", "late_domain_stats", "late_manifest", "weekly_active", "multi_product", "kpis",
           "bundle_metrics", "column_tests"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", PLANNED)
def test_no_nested_loops_when_nothing_fits_a_broadcast(spark, no_broadcast, name):
    text = plan(entry.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "ArrowEval" not in text


def test_dedup_cuts_groups_before_the_shuffle(tables):
    text = plan(first_per_key(tables.subscribers, ["subscriber_id"], ["created_at"]))
    assert len(re.findall("WindowGroupLimit", text)) == 2


def test_the_metric_reads_events_once_and_only_what_it_needs(tables):
    text = plan(daily_active(tables, AS_OF))
    assert len(re.findall(r"FileScan parquet \[event_id", text)) == 1
    assert "props" not in text
    assert "GreaterThanOrEqual(ts,2023-10-26T00:00)" in text or "PushedFilters: [IsNotNull(ts), Gr" in text


def skewed(tables):
    """Two thirds of the events belong to one subscriber or to none."""
    owner = F.expr("CASE event_id % 3 WHEN 0 THEN '3' WHEN 1 THEN subscriber_id END")
    return Tables(tables.subscribers, tables.events.withColumn("subscriber_id", owner), tables.columns)


def test_skewed_metric(tables, no_broadcast):
    hot = skewed(tables)
    a, b = daily_active(hot, AS_OF), daily_active_grouping_sets(hot, AS_OF)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_skewed_health(tables, no_broadcast):
    hot = skewed(tables)
    row = subscriber_health(hot, AS_OF).filter("subscriber_id = '3'").first()
    mine = hot.events.filter("subscriber_id = '3'")
    assert row.news_article_views == mine.filter("product = 'news' AND event_type = 'article_view'").count()
    assert row.games_active_days == mine.filter("product = 'games'").select(F.to_date("event_timestamp")).distinct().count()
    assert row.products_engaged_count == 4


def test_membership_sees_each_key_once(spark, no_broadcast):
    df = spark.range(10000).selectExpr("IF(id % 3 = 0, 1, IF(id % 3 = 1, NULL, id)) AS k")
    ref = spark.sql("SELECT * FROM VALUES (1L), (2L), (NULL) AS t(k)")
    got = membership_counts(df, "k", ref, "k")
    assert got.first().asDict() == {"total": 10000, "matched": 3335, "orphans": 3332, "nulls": 3333}
    text = plan(got)
    # the aggregation on the key comes below the join
    assert text.index("SortMergeJoin") < text.index("partial_count(1)")


def test_enriched_activity_splits_a_hot_subscriber(spark, tables, no_broadcast):
    """The final plan shows the split; activity without a subscriber stays out of the join."""
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        hot = skewed(tables)
        # a hot partition is split between the tasks that wrote it
        many = hot.events.repartition(8).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(20))))
        activity = qualifying_activity(many, AS_OF)
        staged = stage_subscribers(tables.subscribers, AS_OF)
        df = enriched_activity(activity, staged)
        assert df.count() == activity.count()
        rows = df.filter("subscriber_id IS NOT NULL").select("plan_type")
        rows.write.format("noop").mode("overwrite").save()
        rows.collect()
        assert "skew=true" in plan(rows)
        assert df.filter("subscriber_id IS NULL AND plan_type IS NOT NULL").isEmpty()
    finally:
        for key in settings:
            spark.conf.unset(key)


@pytest.mark.parametrize(("name", "scans"), [("price_percentiles", 1), ("late_domain_stats", 2)])
def test_percentiles_read_their_source_once(spark, name, scans):
    """All levels come out of one shuffle; the second scan of the lateness table is that of its other columns."""
    df = entry.queries()[name](spark, SMALL)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert len(re.findall("FileScan", final)) == scans and len(re.findall("ReusedExchange", final)) == 3
