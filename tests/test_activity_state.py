"""Stored bitmaps: the metrics from them, late and repeated increments, numbers that stay."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from subpulse.functions import expressions as X
from subpulse.plans import activity_state as S
from subpulse.plans.daily_active import daily_active
from subpulse.plans.dashboard import daily_readers, weekly_active
from subpulse.queries import AS_OF, FIRST_LOAD
from subpulse.sources import Tables


def only(tables, condition):
    return Tables(tables.subscribers, tables.events.filter(condition), tables.columns)


@pytest.fixture(scope="module")
def loaded(spark, tables, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('activity')}"
    early = F.coalesce(F.col("arrival_ts") < X.as_of_ts(FIRST_LOAD), F.lit(False))
    S.add_activity(spark, only(tables, early), path, AS_OF)
    first = files(path)
    S.add_activity(spark, only(tables, ~early), path, AS_OF)
    return path, first


def files(path):
    return {p.parent.name: p.stat().st_mtime_ns for p in Path(path.removeprefix("file://")).glob("state/*/*.parquet")}


def test_metrics_equal_those_from_events(spark, tables, loaded, rows):
    state = S.read_state(spark, loaded[0])
    assert rows(S.daily_active_of(state, AS_OF)) == rows(daily_active(tables, AS_OF))
    assert rows(S.weekly_active_of(state)) == rows(weekly_active(tables.events))
    assert rows(S.daily_readers_of(state)) == rows(daily_readers(tables.product("news")))


def test_metrics_read_no_events(spark, loaded):
    state = S.read_state(spark, loaded[0])
    for df in (S.daily_active_of(state, AS_OF), S.weekly_active_of(state), S.daily_readers_of(state)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "members" in plan and "event_id" not in plan and "user_id" not in plan
        assert "event_date" in plan.split("PartitionFilters")[1].split("]")[0]


def test_an_increment_replaces_the_dates_it_touches_and_no_others(spark, tables, loaded, rows):
    path, first = loaded
    before, kept = files(path), rows(S.read_state(spark, path).drop("members"))
    some = F.to_date("event_timestamp") == F.lit("2024-01-03").cast("date")
    S.add_activity(spark, only(tables, some), path, AS_OF)  # known events once more
    after = files(path)
    assert {d for d in after if after[d] != before.get(d)} == {"event_date=2024-01-03"}
    assert rows(S.read_state(spark, path).drop("members")) == kept
    assert rows(S.daily_active_of(S.read_state(spark, path), AS_OF)) == rows(daily_active(tables, AS_OF))
    assert any(first[d] == before[d] for d in first) and any(first[d] != before[d] for d in first)  # late events, old dates


def test_numbers_are_dense_and_stay(spark, tmp_path):
    path = f"file://{tmp_path}/numbers"
    ids = spark.range(1000).select(F.format_string("s%05d", "id").alias("subscriber_id"))
    first = {r.subscriber_id: r.number for r in S.number_subscribers(spark, ids.union(ids).unionByName(
        spark.createDataFrame([(None,)], "subscriber_id string")), path).collect()}
    assert sorted(first.values()) == list(range(1, 1001))
    more = spark.range(500, 1500).select(F.format_string("s%05d", "id").alias("subscriber_id"))
    second = {r.subscriber_id: r.number for r in S.number_subscribers(spark, more, path).collect()}
    assert sorted(second.values()) == list(range(1, 1501)) and first.items() <= second.items()
    assert S.number_subscribers(spark, more, path).count() == 1500


def test_one_subscriber_with_most_events_and_many_blocks_of_numbers(spark, tmp_path):
    """Numbers over several bitmaps of a grain; a third of all events by one subscriber, a third by none."""
    path = f"file://{tmp_path}/activity"
    who = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("s"), "id"))
    events = spark.range(210_000).select(
        who.alias("subscriber_id"), F.lit("games").alias("product"), F.lit("web").alias("platform"),
        F.lit("game_complete").alias("event_type"), F.lit(0.0).alias("time_on_page_sec"),
        F.when(F.col("id") % 999 > 0, F.lit("2024-01-02 10:00:00").cast("timestamp_ntz")).alias("event_timestamp"))
    subscribers = spark.createDataFrame([], "subscriber_id string, email_domain string, plan_type string, "
                                            "subscription_start_date string, subscription_end_date string, is_churned boolean, "
                                            "acquisition_channel string, country string, device_primary string, created_at string")
    tables = Tables(subscribers, events, {})
    S.add_activity(spark, tables, path, AS_OF)
    state = S.read_state(spark, path)
    assert state.filter("measure = 'seen'").select("bucket").distinct().count() == 4  # three blocks, and none
    want = events.filter("event_timestamp IS NOT NULL").select(F.count_distinct("subscriber_id")).first()[0]
    assert S.active_between(state, "2024-01-01", "2024-01-31").first()[0] == want
    total = S.daily_active_of(state, AS_OF).filter("product = 'ALL_PRODUCTS'").first()
    assert total.daily_active_subscribers == want
