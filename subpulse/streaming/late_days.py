"""The late-day check on a stream of events, instead of a daily batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from subpulse.functions import expressions as X
from subpulse.operators.late import LateLimits


def late_days_stream(events: DataFrame, limits: LateLimits = LateLimits()) -> DataFrame:
    """Per domain and date: events, late events, share, and whether to recompute.

    There is no watermark: the latest events are what the check is about, so none
    may be dropped. State is one row per domain and calendar date, a few thousand
    in a decade, whatever the number of events. Changed dates are emitted again,
    so the output mode is ``update``.
    """
    event_ts, arrival_ts = X.parsed_ts(events, "event_timestamp"), X.parsed_ts(events, "arrival_ts")
    domain = F.concat(F.lit("events_"), "product")
    lag = X.us_to_hours(X.lag_us(event_ts, arrival_ts))
    timed = events.select("event_id", domain.alias("domain"), event_ts.cast("date").alias("event_date"),
                          (lag > limits.of(domain)).alias("is_late")).dropna(subset=["event_date"])
    days = timed.groupBy("domain", "event_date").agg(
        F.count("event_id").alias("total_events"), F.count_if("is_late").alias("late_events"))
    pct = X.pct(F.col("late_events"), F.col("total_events"))
    return days.withColumns({"late_pct": pct, "needs_reprocessing": pct > limits.day_pct})


def keep_late_days(days: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write a ``late_days_stream`` to a table with one partition per domain and date.

    A changed date replaces its own partition, so a batch that runs twice changes nothing.
    """
    def replace(changed: DataFrame, _: int) -> None:
        (changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("domain", "event_date").parquet(path))

    return (days.writeStream.outputMode("update").foreachBatch(replace).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
