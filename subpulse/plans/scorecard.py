"""Quality scorecard mart: subscribers and news events, one row per dataset and run date.

It differs from the dataset report on purpose: NULL is invalid here, only the
six registered plans are valid, and the status follows the unrounded score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subpulse import rules
from subpulse.functions import expressions as X
from subpulse.operators.relational import membership_counts
from subpulse.sources.tables import Tables

RATIOS = ["completeness_subscriber_id", "completeness_plan_type", "completeness_start_date", "uniqueness_score",
          "timeliness_score", "validity_score", "referential_integrity_score"]
# --- Fixed values: weight of each ratio, in the order they are summed --------
WEIGHTS = [("completeness_subscriber_id", 0.10), ("completeness_plan_type", 0.10), ("completeness_start_date", 0.10),
           ("uniqueness_score", 0.20), ("timeliness_score", 0.15), ("referential_integrity_score", 0.20),
           ("validity_score", 0.15)]


def _counts(df: DataFrame, name: str, domain: str, key_cols: list[str], on_time: Column, valid: Column) -> DataFrame:
    return df.groupBy(F.lit(name).alias("dataset_name"), F.lit(domain).alias("data_domain")).agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count_if(F.col(c).isNotNull()).alias(r) for c, r in zip(key_cols, RATIOS)],
        F.count_if(on_time).alias("timeliness_score"), F.count_if(valid).alias("validity_score"))


def scorecard_ratios(tables: Tables, as_of: X.AsOf = None) -> DataFrame:
    """The unrounded ratios. Distinct keys and matched keys are scalar sub-queries."""
    subs, news = tables.subscribers, tables.product("news")
    subs_counts = _counts(
        subs, "subscribers", "subscriber_domain", ["subscriber_id", "plan_type", "subscription_start_date"],
        F.col("subscription_start_date").try_cast("date") <= X.as_of_date(as_of),
        F.col("plan_type").isin(rules.REGISTERED_PLANS))
    news_counts = _counts(
        news, "events_news", "news_domain", ["event_id", "event_type", "event_timestamp"],
        X.parsed_ts(news, "event_timestamp") <= X.as_of_ts(as_of),
        F.col("event_type").isin(rules.EVENT_TYPES["news"]))
    # staging keeps every subscriber id, so the raw ids are the staged ids
    matched = membership_counts(news, "subscriber_id", subs, "subscriber_id").select("matched")
    total = F.col("total_records")

    def finish(counts: DataFrame, keys: DataFrame, linked: Column) -> DataFrame:
        plain = [r for r in RATIOS if r not in ("uniqueness_score", "referential_integrity_score")]
        return counts.select(
            "dataset_name", "data_domain", X.as_of_date(as_of).alias("run_date"), "total_records",
            *[X.ratio(F.col(r), total).alias(r) for r in plain],
            X.ratio(keys.scalar(), total).alias("uniqueness_score"), linked.alias("referential_integrity_score"))

    return finish(subs_counts, subs.agg(F.count_distinct("subscriber_id")), F.lit(1.0)).unionByName(
        finish(news_counts, news.agg(F.count_distinct("event_id")), X.ratio(matched.scalar(), total)))


def quality_scorecard(tables: Tables, as_of: X.AsOf = None) -> DataFrame:
    ratios = scorecard_ratios(tables, as_of)
    score = X.weighted([(F.col(name), weight) for name, weight in WEIGHTS])
    return (ratios.withColumn("_score", score)
            .select("dataset_name", "data_domain", "run_date", "total_records", *RATIOS,
                    F.round(F.col("_score") * 100, 2).alias("dq_score"),
                    X.score_label(F.col("_score")).alias("dq_status")))


def worst_first(scorecard: DataFrame) -> DataFrame:
    return scorecard.orderBy("dq_score")
