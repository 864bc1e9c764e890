"""Staged subscribers and events, and the quarantined complement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subpulse.functions import expressions as X
from subpulse.operators.relational import first_per_key
from subpulse.rules import PLAN_ACCESS


def stage_subscribers(raw: DataFrame, as_of: X.AsOf = None) -> DataFrame:
    """One typed row per subscriber: the first written, with access flags, tier and tenure."""
    first = first_per_key(raw, ["subscriber_id"], ["created_at"])
    start = F.col("subscription_start_date").try_cast("date")
    end = F.col("subscription_end_date").try_cast("date")
    return first.select(
        "subscriber_id", "email_domain", "plan_type",
        start.alias("subscription_start_date"),
        end.alias("subscription_end_date"),
        "is_churned", "acquisition_channel", "country", "device_primary",
        X.parsed_ts(first, "created_at").alias("created_at"),
        *[X.has_access(p).alias(f"has_{p}_access") for p in PLAN_ACCESS],
        X.bundle_tier(F.col("plan_type")).alias("bundle_tier"),
        X.tenure_days(start, end, X.as_of_date(as_of)).alias("tenure_days"),
    )


def validate_events(raw: DataFrame, as_of: X.AsOf = None) -> DataFrame:
    """Raw events of any product with typed time, capped dwell and quality flags.

    Every raw column but the lateness input is kept; the event date follows the
    time as reported, not the clamped one.
    """
    now = X.as_of_ts(as_of)
    ts = X.parsed_ts(raw, "event_timestamp")
    out = []
    for name in raw.columns:
        if name == "event_timestamp":
            out += [ts.alias(name), X.clamped_ts(ts, now).alias("event_timestamp_clean"),
                    ts.cast("date").alias("event_date")]
        elif name == "time_on_page_sec":
            out.append(X.capped_dwell(F.col(name)).alias(name))
        elif name not in ("arrival_ts", "event_date"):
            out.append(F.col(name))
    out.append(F.col("subscriber_id").isNull().alias("is_orphaned_event"))
    out.append((ts > now).alias("has_future_timestamp"))
    if "time_on_page_sec" in raw.columns:
        out.append(F.col("time_on_page_sec").isNull().alias("is_missing_dwell_time"))
    return raw.select(*out)


def stage_events(raw: DataFrame, as_of: X.AsOf = None) -> DataFrame:
    """Validated events that have a subscriber."""
    return validate_events(raw, as_of).filter(~F.col("is_orphaned_event"))


def quarantine_events(raw: DataFrame, as_of: X.AsOf = None) -> DataFrame:
    """Validated events without a subscriber."""
    return validate_events(raw, as_of).filter("is_orphaned_event")
