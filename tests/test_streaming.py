from pyspark.sql import functions as F

from subpulse.operators import late
from subpulse.streaming.late_days import keep_late_days, late_days_stream


def test_stream_agrees_with_the_batch_however_late_events_are(spark, tables, tmp_path, rows):
    """A far-off event comes first and the oldest days last; nothing is lost."""
    columns = ["event_id", "product", "event_timestamp", "arrival_ts"]
    landed, out = f"file://{tmp_path}/landed", f"file://{tmp_path}/out"
    events = tables.events.select(*columns)
    spark.sql("SELECT 0L AS event_id, 'news' AS product, TIMESTAMP_NTZ '2025-01-01' AS event_timestamp, "
              "TIMESTAMP_NTZ '2025-01-01' AS arrival_ts").write.parquet(landed)
    for first, last in (("2024-01-20", "2024-02-01"), ("2024-01-10", "2024-01-20"), ("2024-01-01", "2024-01-10")):
        events.filter(f"event_timestamp >= TIMESTAMP_NTZ '{first}' AND event_timestamp < TIMESTAMP_NTZ '{last}'").coalesce(
            1).write.mode("append").parquet(landed)

    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(landed)
    query = keep_late_days(late_days_stream(stream), out, f"file://{tmp_path}/state")
    assert query.awaitTermination(240)
    got = spark.read.parquet(out).select("domain", "event_date", "total_events", "late_events", "late_pct",
                                         "needs_reprocessing").filter("event_date < DATE '2025-01-01'")
    assert rows(got) == rows(late.late_days(late.with_lag(tables.events)))
    assert got.filter(F.col("needs_reprocessing")).count() == 63
