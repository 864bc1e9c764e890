"""Late arrivals: lag between event and arrival, and the dates to recompute."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subpulse import rules
from subpulse.functions import expressions as X
from subpulse.functions.local import constant_table
from subpulse.operators.quantiles import exact_percentiles
from subpulse.sources.tables import Tables


@dataclass(frozen=True)
class LateLimits:
    """From when an event is late, and what follows from it."""
    hours: Mapping[str, float] = field(default_factory=lambda: dict(rules.LATE_AFTER_HOURS))
    other_hours: float = rules.DEFAULT_LATE_AFTER_HOURS     # for domains not in ``hours``
    day_pct: float = rules.REPROCESS_DAY_PCT                # a date with more late events is recomputed
    high_pct: float = rules.HIGH_PRIORITY_PCT               # a domain with more has priority
    warn_pct: float = rules.DOMAIN_WARNING_PCT

    @classmethod
    def after(cls, hours: float) -> LateLimits:
        """One threshold for all domains."""
        return cls({domain: hours for domain in rules.LATE_AFTER_HOURS}, hours)

    def of(self, domain: Column) -> Column:
        return X.keyed(domain, dict(self.hours), self.other_hours)


def limits_table(spark: SparkSession, limits: LateLimits) -> DataFrame:
    """The thresholds, for the header of a report."""
    rows = [(f"late after hours: {d}", float(h)) for d, h in limits.hours.items()] + [
        ("late after hours: other", float(limits.other_hours)), ("recompute a date above percent", limits.day_pct),
        ("high priority above percent", limits.high_pct), ("warning above percent", limits.warn_pct)]
    return constant_table(spark, {"name": "string", "value": "double"}, rows)


def with_lag(events: DataFrame, limits: LateLimits = LateLimits()) -> DataFrame:
    """Event rows of all products with domain, lag, late flag and lag bucket."""
    event_ts, arrival_ts = X.parsed_ts(events, "event_timestamp"), X.parsed_ts(events, "arrival_ts")
    rows = events.select("event_id", F.concat(F.lit("events_"), "product").alias("domain"), "platform",
                         event_ts.cast("date").alias("event_date"), X.lag_us(event_ts, arrival_ts).alias("lag_us"))
    rows = rows.withColumn("lag_hours", X.us_to_hours(F.col("lag_us")))
    return rows.withColumns({
        "is_late": F.coalesce(F.col("lag_hours") > limits.of(F.col("domain")), F.lit(False)),
        "lag_bucket": X.lag_bucket(F.col("lag_hours")),
    })


def late_days(lagged: DataFrame, limits: LateLimits = LateLimits()) -> DataFrame:
    """Per domain and date: events, late events, share, and whether to recompute.

    The share is rounded before it is compared.
    """
    counts = lagged.dropna(subset=["event_date"]).groupBy("domain", "event_date").agg(
        F.count("event_id").alias("total_events"), F.count_if("is_late").alias("late_events"))
    return (counts.withColumn("late_pct", X.pct(F.col("late_events"), F.col("total_events")))
            .withColumn("needs_reprocessing", F.col("late_pct") > limits.day_pct))


def late_buckets(lagged: DataFrame) -> DataFrame:
    """Events per domain and lag bucket, empty buckets included."""
    spark = lagged.sparkSession
    labels = ", ".join(f"('{d}', '{label}')" for d in rules.LATE_AFTER_HOURS for _, label in rules.LAG_BUCKETS)
    every = spark.sql(f"SELECT * FROM VALUES {labels} AS t(domain, lag_bucket)")
    counted = lagged.dropna(subset=["lag_bucket"]).groupBy("domain", "lag_bucket").agg(
        F.count(F.lit(1)).alias("events"))
    return every.join(counted, ["domain", "lag_bucket"], "left").fillna(0, subset=["events"])


def late_platforms(lagged: DataFrame) -> DataFrame:
    """Per domain and platform: events, late events, mean and 95th percentile lag."""
    known = lagged.dropna(subset=["platform"])
    counts = known.groupBy("domain", "platform").agg(
        F.count("event_id").alias("total_events"), F.count_if("is_late").alias("late_events"),
        F.round(X.us_to_hours(F.try_divide(F.sum("lag_us"), F.count("lag_us"))), 2).alias("avg_lag_hours"))
    p95 = exact_percentiles(known, ["domain", "platform"], "lag_us", {"p95_us": 0.95})
    return counts.join(p95, ["domain", "platform"], "left").select(
        "domain", "platform", "total_events", "late_events", "avg_lag_hours",
        F.round(X.us_to_hours(F.col("p95_us")), 2).alias("p95_lag_hours"))


def late_shares(lagged: DataFrame) -> DataFrame:
    """Per domain: events, late events and late share."""
    counts = lagged.groupBy("domain").agg(
        F.count(F.lit(1)).alias("total_events"), F.count_if("is_late").alias("late_events"))
    return counts.withColumn("late_pct", X.pct(F.col("late_events"), F.col("total_events")))


def late_domain_stats(lagged: DataFrame, limits: LateLimits = LateLimits()) -> DataFrame:
    """Per domain: threshold, totals, late share, lag statistics and days to recompute."""
    per_day = lagged.groupBy("domain", "event_date").agg(
        F.count(F.lit(1)).alias("n"), F.count("event_id").alias("ids"), F.count_if("is_late").alias("late"),
        F.sum("lag_us").alias("lag_sum"), F.count("lag_us").alias("lag_n"), F.max("lag_us").alias("lag_max"))
    flagged = F.col("event_date").isNotNull() & (X.pct(F.col("late"), F.col("ids")) > limits.day_pct)
    base = per_day.groupBy("domain").agg(
        F.sum("n").alias("total_events"), F.sum("late").alias("late_events"),
        X.us_to_hours(F.try_divide(F.sum("lag_sum"), F.sum("lag_n"))).alias("avg_lag"),
        X.us_to_hours(F.max("lag_max")).alias("max_lag"),
        F.count_if(flagged).alias("reprocess_day_count"))
    quantiles = exact_percentiles(lagged, ["domain"], "lag_us", {"p50_us": 0.5, "p95_us": 0.95})
    return base.join(quantiles, "domain", "left").select(
        "domain", limits.of(F.col("domain")).alias("threshold_hours"), "total_events", "late_events",
        X.pct(F.col("late_events"), F.col("total_events")).alias("late_pct"),
        F.round("avg_lag", 3).alias("avg_lag_hours"),
        F.round(X.us_to_hours(F.col("p50_us")), 3).alias("p50_lag_hours"),
        F.round(X.us_to_hours(F.col("p95_us")), 3).alias("p95_lag_hours"),
        F.round("max_lag", 3).alias("max_lag_hours"), "reprocess_day_count")


def reprocessing_manifest(lagged: DataFrame, limits: LateLimits = LateLimits()) -> DataFrame:
    """One row per domain and date to recompute; the priority follows the domain's share.

    Both grains come from one aggregation by domain and date: the domain share
    is a window over its dates, at most one row per calendar day.
    """
    per_day = lagged.groupBy("domain", "event_date").agg(
        F.count(F.lit(1)).alias("n"), F.count("event_id").alias("ids"), F.count_if("is_late").alias("late"))
    whole = Window.partitionBy("domain")
    share = X.pct(F.sum("late").over(whole), F.sum("n").over(whole))
    return (per_day
            .withColumns({"domain_pct": share, "late_pct": X.pct(F.col("late"), F.col("ids"))})
            .filter(F.col("event_date").isNotNull() & (F.col("late_pct") > limits.day_pct))
            .select("domain", "event_date", "late_pct",
                    F.when(F.col("domain_pct") > limits.high_pct, "high").otherwise("normal").alias("priority")))


def late_summary(lagged: DataFrame, limits: LateLimits = LateLimits()) -> DataFrame:
    """One row: totals, late share, domains to recompute and number of jobs."""
    days = lagged.groupBy("domain", "event_date").agg(
        F.count(F.lit(1)).alias("n"), F.count("event_id").alias("ids"), F.count_if("is_late").alias("late"))
    flagged = F.col("event_date").isNotNull() & (X.pct(F.col("late"), F.col("ids")) > limits.day_pct)
    per_domain = days.groupBy("domain").agg(
        F.sum("n").alias("n"), F.sum("late").alias("late"), F.count_if(flagged).alias("jobs"))
    return per_domain.agg(
        F.sum("n").alias("total_events"), F.sum("late").alias("total_late"),
        X.pct(F.sum("late"), F.sum("n")).alias("overall_late_pct"),
        F.count_if(F.col("jobs") > 0).alias("domains_with_reprocessing"),
        F.sum("jobs").alias("total_reprocess_jobs"),
        F.count_if(X.pct(F.col("late"), F.col("n")) > limits.warn_pct).alias("domains_warned"))


def dates_to_reprocess(manifest: DataFrame) -> DataFrame:
    """Distinct dates of the manifest: at most one row per calendar day."""
    return manifest.select("event_date").distinct()


def events_on(tables: Tables, dates: DataFrame, first: date, last: date) -> Tables:
    """The tables, with events only of the given dates, which lie from ``first`` to ``last``.

    The bounds are written on the bare timestamp, so they reach the scan.
    """
    ts = X.parsed_ts(tables.events, "event_timestamp")
    near = tables.events.filter(X.on_or_after(ts, F.lit(first)) & ~X.on_or_after(ts, F.lit(last + timedelta(days=1))))
    keyed = near.withColumn("_day", ts.cast("date"))
    kept = keyed.join(dates.select(F.col("event_date").alias("_day")), "_day", "left_semi").drop("_day")
    return Tables(tables.subscribers, kept, tables.columns)
