"""Daily activity as stored bitmaps: exact distinct counts that merge, and increments that never reread old events.

Subscribers are numbered densely, once; a number never changes. The state holds,
per date and grain, the set of active subscribers as bitmaps of 32,768 numbers
each. Bitmaps of a grain are merged by OR, so

- new events change the dates they belong to, however late they come: their own
  bitmaps are merged into the stored ones, and those dates are replaced;
- counts over several grains or dates (a product, a week) are counts of merged
  bitmaps, exact, with no look at events.

Two measures are kept: ``active``, qualifying activity by product, platform, tier
and country, and ``seen``, all events by product. Activity without a subscriber
has a row without a bitmap, which keeps its group. Tier and country are those of
the subscriber when the activity is added.

A subscriber with a third of all events is one bit of a date's bitmap: activity is
made distinct on the map side before it is numbered. A grain's bitmaps are as many
as there are blocks of numbers, 4 KB each at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from subpulse import rules
from subpulse.functions import expressions as X
from subpulse.operators.relational import trailing_days
from subpulse.plans.daily_active import COLUMNS, COUNTS, DETAIL, qualifying_activity
from subpulse.plans.staging import stage_subscribers
from subpulse.session import settle
from subpulse.sinks.writers import write_by_date
from subpulse.sources.tables import Tables

GRAIN = ["event_date", "measure", "product", "platform", "bundle_tier", "country"]
NUMBERS = "subscriber_id string, number long"
STATE = "measure string, product string, platform string, bundle_tier string, country string, bucket long, members binary, event_date date"


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A stored table, or None before the first load; any other failure is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def dense_numbers(ids: DataFrame, column: str, after: int = 0) -> DataFrame:
    """(column, number): the distinct values numbered after + 1, after + 2, ... without a gap.

    Values are dealt out by range and numbered where they stand; one row per
    partition says how many came before.
    """
    placed = settle(ids.select(column).filter(F.col(column).isNotNull()).distinct().repartitionByRange(column)
                    .sortWithinPartitions(column).withColumns(
                        {"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()}), "placed")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    parts = placed.groupBy("part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    return placed.join(parts, "part").select(
        column, (F.col("place") - F.col("first") + F.col("before") + 1 + after).alias("number"))


def number_subscribers(spark: SparkSession, events: DataFrame, path: str) -> DataFrame:
    """The stored numbers, after adding those of subscribers that the events have for the first time."""
    known = _stored(spark, path, NUMBERS)
    highest = 0 if known is None else known.agg(F.max("number")).first()[0] or 0
    met = events.select("subscriber_id")
    new = met if known is None else met.distinct().join(known, "subscriber_id", "left_anti")
    dense_numbers(new, "subscriber_id", highest).write.mode("append").parquet(path)
    return spark.read.schema(NUMBERS).parquet(path)


def _bitmaps(members: DataFrame) -> DataFrame:
    """(*GRAIN, bucket, members) of rows (*GRAIN, number); rows without a number keep their group."""
    return members.groupBy(*GRAIN, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("members")).withColumn(
        "members", F.when(F.col("bucket").isNotNull(), F.col("members")))


def merged(state: DataFrame, *by: str) -> DataFrame:
    """Bitmaps of ``by`` and bucket: the subscribers of any of its rows."""
    return state.groupBy(*by, "bucket").agg(F.bitmap_or_agg("members").alias("members")).withColumn(
        "members", F.when(F.col("bucket").isNotNull(), F.col("members")))


def activity_bitmaps(tables: Tables, numbers: DataFrame, as_of: X.AsOf) -> DataFrame:
    """The state of these events alone, all dates."""
    none = F.lit(None).cast("string")
    dims = stage_subscribers(tables.subscribers, as_of).select("subscriber_id", "bundle_tier", "country")
    active = (qualifying_activity(tables.events, as_of, None).select("event_date", "product", "platform", "subscriber_id")
              .distinct().join(dims, "subscriber_id", "left").withColumn("measure", F.lit("active")))
    date = X.parsed_ts(tables.events, "event_timestamp").cast("date")
    seen = tables.events.select(date.alias("event_date"), "product", "subscriber_id").distinct().withColumns(
        {"measure": F.lit("seen"), "platform": none, "bundle_tier": none, "country": none})
    rows = active.select(*GRAIN, "subscriber_id").unionByName(seen.select(*GRAIN, "subscriber_id"))
    dated = rows.filter("event_date IS NOT NULL")
    return _bitmaps(dated.join(numbers, "subscriber_id", "left").select(*GRAIN, "number"))


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATE).parquet(f"{path}/state")


def add_activity(spark: SparkSession, tables: Tables, path: str, as_of: X.AsOf) -> None:
    """Merge new events into the state below ``path``. Reads these events and the stored dates that they touch.

    Adding the same events again changes nothing.
    """
    numbers = number_subscribers(spark, tables.events, f"{path}/numbers")
    new = settle(activity_bitmaps(tables, numbers, as_of), "new_activity")
    dates = new.select("event_date").distinct()
    stored, merge = _stored(spark, f"{path}/state", STATE), new
    if stored is not None:
        touched = stored.join(dates, "event_date", "left_semi").select(new.columns)
        merge = settle(merged(touched.unionByName(new), *GRAIN), "merged_activity")
    write_by_date(merge.select("measure", "product", "platform", "bundle_tier", "country", "bucket", "members", "event_date"),
                  f"{path}/state", ("measure", "product"))


def _count(col: str | Column = "members") -> Column:
    return F.coalesce(F.sum(F.bitmap_count(col)), F.lit(0)).cast("long")


def daily_active_of(state: DataFrame, as_of: X.AsOf, lookback_days: int | None = rules.LOOKBACK_DAYS) -> DataFrame:
    """The daily metric from the state: detail rows, and a total of each date over all products."""
    active = state.filter("measure = 'active'")
    if lookback_days is not None:
        active = active.filter(F.col("event_date") >= X.lookback_start(as_of, lookback_days))

    def tiers(members: str) -> list[Column]:
        return [_count(members).alias(COUNTS[0])] + [
            _count(F.when(F.col("tier") == t, F.col(members))).alias(f"daily_active_{t}") for t in rules.TIERS]

    detail = active.withColumn("tier", F.col("bundle_tier")).groupBy(*DETAIL).agg(*tiers("members"))
    none = F.lit(None).cast("string")
    total = merged(active.withColumn("tier", F.col("bundle_tier")), "event_date", "tier").groupBy("event_date").agg(
        *tiers("members")).withColumns({"product": F.lit(rules.ALL_PRODUCTS), "platform": none, "bundle_tier": none,
                                        "country": none})
    both = detail.select(*DETAIL, *COUNTS).unionByName(total.select(*DETAIL, *COUNTS))
    return both.withColumns({"_model_updated_at": X.as_of_ts(as_of), "_metric_version": F.lit(rules.METRIC_VERSION)}
                            ).select(*COLUMNS)


def weekly_active_of(state: DataFrame) -> DataFrame:
    """Distinct subscribers per product from 7 days before the newest news or games date on."""
    seen = state.filter("measure = 'seen'")
    newest = seen.filter(F.col("product").isin("news", "games")).agg(F.max("event_date").alias("newest"))
    return merged(trailing_days(seen, "event_date", newest, 7), "product").groupBy("product").agg(
        _count().alias("active_subscribers"))


def daily_readers_of(state: DataFrame) -> DataFrame:
    """Distinct readers of news per date, from 30 days before the newest date on."""
    seen = state.filter("measure = 'seen' AND product = 'news'")
    newest = seen.agg(F.max("event_date").alias("newest"))
    return trailing_days(seen, "event_date", newest, 30).groupBy("event_date").agg(_count().alias("readers"))


def active_between(state: DataFrame, first: str, last: str, products: tuple[str, ...] = rules.PRODUCTS) -> DataFrame:
    """Distinct subscribers of any of these products over a span of dates, one row: a question nobody stored an answer to."""
    span = state.filter((F.col("measure") == "seen") & F.col("product").isin(list(products))
                        & F.col("event_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    buckets = merged(span.withColumn("all", F.lit(1)), "all")
    return buckets.agg(_count().alias("active_subscribers"))
