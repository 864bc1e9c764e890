"""Engagement per subscriber and the subscriber-health mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subpulse import rules
from subpulse.functions import expressions as X
from subpulse.plans.staging import stage_subscribers
from subpulse.sources.tables import Tables

# product -> measures it contributes, in output order
MEASURES = {
    "news": ["news_active_days", "news_article_views", "news_articles_completed", "news_completion_rate",
             "news_avg_dwell_sec", "news_last_active_date"],
    "games": ["games_active_days", "games_completed", "games_distinct_played", "games_max_streak",
              "games_last_active_date"],
    "cooking": ["cooking_active_days", "recipes_cooked", "recipes_saved", "cooking_last_active_date"],
    "athletic": ["athletic_active_days", "athletic_article_views", "athletic_last_active_date"],
}
# kept NULL for a subscriber without activity; every other measure becomes 0
NULLABLE = {"news_avg_dwell_sec"} | {f"{p}_last_active_date" for p in rules.PRODUCTS}
# product -> event type counted by a measure; at most two per product
EVENT_COUNTS = {
    "news": {"article_view": "news_article_views", "article_complete": "news_articles_completed"},
    "games": {"game_complete": "games_completed"},
    "cooking": {"cook_mode_complete": "recipes_cooked", "save": "recipes_saved"},
    "athletic": {"article_view": "athletic_article_views"},
}
_COUNTERS = ("first", "second")


def engagement_all(events: DataFrame, as_of: X.AsOf = None,
                   lookback_days: int = rules.LOOKBACK_DAYS) -> DataFrame:
    """Engagement with every product per subscriber, in one pass over the events.

    First per subscriber, product and day, with one more row per game played;
    the distinct days and games of a subscriber are then plain counts of rows.
    Both steps are hash aggregations combined on the map side: no sets are
    gathered, and a subscriber with very many events sends a few rows per day.
    """
    ts = X.parsed_ts(events, "event_timestamp")
    absent = {c: F.lit(None).cast(t) for c, t in (
        ("time_on_page_sec", "double"), ("game_name", "string"), ("streak_days", "bigint")) if c not in events.columns}
    rows = (events.filter(X.on_or_after(ts, X.lookback_start(as_of, lookback_days)))
            .withColumns({**absent, "event_date": ts.cast("date")})
            .withColumn("dwell", F.when(F.col("product") == "news", X.capped_dwell(F.col("time_on_page_sec")))))
    kinds = " ".join(
        f"WHEN '{p}' THEN CASE event_type " + " ".join(f"WHEN '{e}' THEN '{c}'" for e, c in zip(counted, _COUNTERS))
        + " END" for p, counted in EVENT_COUNTS.items())
    day = "named_struct('day', event_date, 'game', CAST(NULL AS STRING))"
    game = "named_struct('day', CAST(NULL AS DATE), 'game', game_name)"
    keyed = rows.selectExpr(
        "subscriber_id", "product", "dwell", "streak_days", f"CASE product {kinds} END AS kind",
        f"inline(IF(product = 'games' AND game_name IS NOT NULL, array({day}, {game}), array({day})))")
    daily = keyed.groupBy("subscriber_id", "product", "day", "game").agg(
        *[F.expr(f"count_if(kind = '{c}') AS {c}") for c in _COUNTERS],
        F.expr("sum(dwell) AS dwell_sum"), F.expr("count(dwell) AS dwell_n"), F.expr("max(streak_days) AS streak"))

    def over(p: str, text: str) -> Column:
        return F.expr(text.format(f"FILTER (WHERE product = '{p}' AND day IS NOT NULL)"))

    per_product = [column for p, counted in EVENT_COUNTS.items() for column in (
        over(p, f"count(1) {{}} AS {p}_active_days"), over(p, f"max(day) {{}} AS {p}_last_active_date"),
        *[over(p, f"coalesce(sum({c}) {{}}, 0L) AS {name}") for name, c in zip(counted.values(), _COUNTERS)])]
    totals = daily.groupBy("subscriber_id").agg(
        *per_product, F.expr("try_divide(sum(dwell_sum), sum(dwell_n)) AS news_avg_dwell_sec"),
        F.count("game").alias("games_distinct_played"), over("games", "max(streak) {} AS games_max_streak"))
    rate = X.ratio(F.col("news_articles_completed"), F.col("news_article_views"))
    return totals.withColumn("news_completion_rate", rate).select(
        "subscriber_id", *[m for p in rules.PRODUCTS for m in MEASURES[p]])


def engagement(events: DataFrame, product: str, as_of: X.AsOf = None,
               lookback_days: int = rules.LOOKBACK_DAYS) -> DataFrame:
    """Engagement of one product's raw events per subscriber; news leaves out orphans."""
    rows = events.filter(F.col("subscriber_id").isNotNull()) if product == "news" else events
    whole = engagement_all(rows.withColumn("product", F.lit(product)), as_of, lookback_days)
    return whole.select("subscriber_id", *MEASURES[product])


def subscriber_health(tables: Tables, as_of: X.AsOf = None, lookback_days: int = rules.LOOKBACK_DAYS) -> DataFrame:
    """Staged subscribers with engagement, breadth, recency, churn risk and revenue."""
    staged = stage_subscribers(tables.subscribers, as_of)
    known = tables.events.filter(F.col("subscriber_id").isNotNull())
    joined = staged.join(engagement_all(known, as_of, lookback_days), "subscriber_id", "left")
    measures = [
        F.col(m) if m in NULLABLE else F.coalesce(F.col(m), F.lit(0)).alias(m)
        for p in rules.PRODUCTS for m in MEASURES[p]
    ]
    enriched = joined.select(*staged.columns, *measures)

    breadth = sum((F.when(F.col(f"{p}_active_days") > 0, 1).otherwise(0) for p in rules.PRODUCTS), F.lit(0))
    never = X.day("1970-01-01")
    idle = F.least(*[F.datediff(X.as_of_date(as_of), F.coalesce(F.col(f"{p}_last_active_date"), never))
                     for p in rules.PRODUCTS])
    scored = enriched.withColumns({"products_engaged_count": breadth, "days_since_last_activity": idle})
    return scored.withColumns({
        "churn_risk_tier": X.churn_risk_tier(
            F.col("days_since_last_activity"), F.col("bundle_tier"), F.col("products_engaged_count")),
        "mrr_estimate_usd": X.mrr_of_tier(F.col("bundle_tier")),
    })


def churn_risk_summary(health: DataFrame) -> DataFrame:
    return health.groupBy("bundle_tier", "churn_risk_tier").agg(
        F.count(F.lit(1)).alias("subscribers"), F.sum("mrr_estimate_usd").alias("mrr_usd"))


def health_snapshot(tables: Tables, as_of: str, lookback_days: int = rules.LOOKBACK_DAYS) -> DataFrame:
    """The mart at subscriber x day grain: one run, dated."""
    return subscriber_health(tables, as_of, lookback_days).withColumn("snapshot_date", X.as_of_date(as_of))


def engagement_velocity(events: DataFrame, as_of: X.AsOf = None, short: int = 7, long: int = 30) -> DataFrame:
    """Events per day over the trailing short and long windows, and their ratio."""
    ts = X.parsed_ts(events, "event_timestamp")
    rows = events.filter(
        X.on_or_after(ts, X.lookback_start(as_of, long)) & (ts <= X.as_of_ts(as_of))
        & F.col("subscriber_id").isNotNull())
    recent = X.on_or_after(ts, X.lookback_start(as_of, short))
    counted = rows.groupBy("subscriber_id").agg(
        F.count_if(recent).alias("events_short"), F.count(F.lit(1)).alias("events_long"))
    return counted.withColumn(
        "velocity", F.round((F.col("events_short") / F.lit(float(short))) / (F.col("events_long") / F.lit(float(long))), 6))
