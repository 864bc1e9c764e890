"""Whole reports as JSON lines: one (section, body) row per row of each part.

A report may list every platform, date or value there is, so its parts stay
rows; nothing is gathered into one document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subpulse import rules
from subpulse.functions import expressions as X
from subpulse.operators import drift, late, quality
from subpulse.plans import dashboard
from subpulse.sinks.writers import as_json
from subpulse.sources.tables import Tables


def report_lines(parts: dict[str, DataFrame]) -> DataFrame:
    """(section, body): the rows of every part as JSON text."""
    lines = [as_json(df, "body").select(F.lit(name).alias("section"), "body") for name, df in parts.items()]
    return reduce(DataFrame.unionByName, lines)


def read_lines(lines: DataFrame, parts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The parts again, out of (section, body) rows, with the columns that ``parts`` have."""
    return {name: lines.filter(F.col("section") == name).select(
        F.from_json("body", df.schema, {"mode": "FAILFAST"}).alias("row")).select("row.*") for name, df in parts.items()}


def quality_parts(tables: Tables, as_of: X.AsOf = None) -> dict[str, DataFrame]:
    report = quality.quality_report(tables, as_of)
    return {"summary": quality.quality_summary(report), "dataset": report.select(
        "dataset_name", "domain", "run_at", "total_records", "composite_score", "status"),
        "dimension": quality.quality_dimensions(report), "gate": quality.quality_gates(report)}


def drift_parts(datasets: dict[str, DataFrame]) -> dict[str, DataFrame]:
    events = drift.detect_drift(datasets)
    status = drift.drift_status(events, list(datasets))
    spark = events.sparkSession
    parts = {"registry": spark.sql(f"SELECT '{rules.REGISTRY_VERSION}' AS version"),
             "summary": drift.drift_summary(status), "dataset": status, "event": events,
             "columns": drift.column_counts(spark, {n: df.schema for n, df in datasets.items()}),
             "gate": drift.drift_gates(status)}
    violations = drift.enum_violations(datasets)
    return parts if violations is None else {**parts, "unknown_value": violations}


def late_parts(tables: Tables, limits: late.LateLimits = late.LateLimits()) -> dict[str, DataFrame]:
    lagged = late.with_lag(tables.events, limits)
    return {
        "summary": late.late_summary(lagged, limits), "domain": late.late_domain_stats(lagged, limits),
        "platform": late.late_platforms(lagged), "bucket": late.late_buckets(lagged),
        "manifest": late.reprocessing_manifest(lagged, limits), "limits": late.limits_table(lagged.sparkSession, limits)}


def dashboard_parts(tables: Tables, as_of: X.AsOf = None) -> dict[str, DataFrame]:
    subs, events = tables.subscribers, tables.events
    return {
        "kpis": dashboard.kpis(tables, as_of), "plan": dashboard.plan_distribution(subs),
        "churn": dashboard.churn_by_plan(subs), "acquisition": dashboard.acquisition_distribution(subs),
        "tier": dashboard.tier_distribution(subs), "weekly_active": dashboard.weekly_active(events),
        "game": dashboard.game_completions(tables.product("games")),
        "daily_readers": dashboard.daily_readers(tables.product("news")),
        "multi_product": dashboard.multi_product(events), "risk": dashboard.risk_buckets(subs, as_of),
        "section": dashboard.section_readers(tables.product("news"))}
