import numpy as np
import pytest
from pyspark.sql import functions as F

from subpulse.operators import late
from subpulse.operators.quantiles import exact_percentiles


def lagged(spark, *rows):
    """(product, platform, event time, lag in minutes) -> rows with lag."""
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "event_id int, product string, platform string, at string, minutes int")
    ts = F.col("at").try_cast("timestamp_ntz")
    return late.with_lag(df.select("event_id", "product", "platform", ts.alias("event_timestamp"),
                                   F.timestamp_add("MINUTE", "minutes", ts).alias("arrival_ts")))


def test_the_threshold_itself_is_on_time(spark):
    df = lagged(spark, ("news", "web", "2024-01-01 00:00:00", 120), ("news", "web", "2024-01-01 00:00:00", 121),
                ("games", "web", "2024-01-01 00:00:00", 240), ("athletic", "web", "2024-01-01 00:00:00", 181),
                ("podcasts", "web", "2024-01-01 00:00:00", 121), ("news", "web", None, 500))
    assert [r.is_late for r in df.orderBy("event_id").collect()] == [False, True, False, True, True, False]


def test_a_share_of_five_percent_is_not_reprocessed(spark):
    def day(d, n, n_late):
        return [("news", "web", f"2024-01-0{d} 10:00:00", 300)] * n_late + [
            ("news", "web", f"2024-01-0{d} 11:00:00", 1)] * (n - n_late)

    # 5.00 %, 5.26 %, and 7.14 %; the domain's share decides the priority
    df = lagged(spark, *day(1, 20, 1), *day(2, 19, 1), *day(3, 14, 1), *day(4, 30, 0))
    manifest = late.reprocessing_manifest(df)
    assert [(str(r.event_date), r.late_pct, r.priority) for r in manifest.orderBy("event_date").collect()] == [
        ("2024-01-02", 5.26, "normal"), ("2024-01-03", 7.14, "normal")]
    assert late.dates_to_reprocess(manifest).count() == 2


def test_null_platforms_and_dates_are_left_out(spark):
    df = lagged(spark, ("games", None, "2024-01-01 00:00:00", 10), ("games", "ios", None, 10),
                ("games", "ios", "2024-01-01 00:00:00", 30))
    platforms = late.late_platforms(df).collect()
    assert [(r.platform, r.total_events, r.p95_lag_hours) for r in platforms] == [("ios", 2, 0.5)]
    assert [r.total_events for r in late.late_days(df).collect()] == [2]
    stats = late.late_domain_stats(df).first()
    assert (stats.total_events, stats.avg_lag_hours) == (3, round((10 / 60 + 0.5) / 2, 3))


def test_empty_buckets_are_listed(spark):
    found = late.late_buckets(lagged(spark, ("news", "web", "2024-01-01 00:00:00", 10)))
    assert found.count() == 20 and found.filter("events = 1").first().lag_bucket == "<30min"


@pytest.mark.parametrize("values", [
    [7], [1, 2], [0, 0, 0, 5], [-10, -5, 3, 2**33, 2**40 + 1], list(range(1000)),
    [1] * 700 + list(range(300)), [-(2**35)] * 3 + [2**35] * 2])
def test_percentiles_equal_numpy(spark, values):
    df = spark.createDataFrame([("g", v) for v in values] + [("g", None), (None, 1)], "k string, v bigint")
    wanted = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    row = exact_percentiles(df, ["k"], "v", wanted).first()
    for name, p in wanted.items():
        assert row[name] == pytest.approx(np.quantile(np.array(values, dtype=float), p), rel=1e-12, abs=1e-9)


def test_percentiles_of_many_groups_with_a_hot_one(spark):
    df = spark.range(30000).selectExpr(
        "IF(id % 3 = 0, 0, id % 50) AS k", "CAST(pmod(xxhash64(id), 5000000000) AS BIGINT) AS v")
    got = {r.k: r.p95 for r in exact_percentiles(df, ["k"], "v", {"p95": 0.95}).collect()}
    want = {r.k: r.p for r in df.groupBy("k").agg(F.expr("percentile(v, 0.95)").alias("p")).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)


def test_lag_does_not_depend_on_the_session_zone(spark):
    # 2024-03-10 02:30 does not exist in New York
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = lagged(spark, ("news", "web", "2024-03-10 01:30:00", 120), ("news", "web", "2024-11-03 00:30:00", 180))
        assert [r.lag_us for r in df.orderBy("event_id").collect()] == [120 * 60_000_000, 180 * 60_000_000]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
