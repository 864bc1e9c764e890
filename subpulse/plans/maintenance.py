"""Keeping the stored daily metric current: first load, increments, late repairs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subpulse import rules
from subpulse.functions import expressions as X
from subpulse.operators.late import dates_to_reprocess, events_on, reprocessing_manifest, with_lag
from subpulse.plans.daily_active import COLUMNS, daily_active
from subpulse.session import settle
from subpulse.sinks.writers import write_by_date
from subpulse.sources.tables import Tables

CLUSTER = ("product", "bundle_tier")


def read_metric(spark: SparkSession, path: str) -> DataFrame:
    """The stored metric, columns in their declared order."""
    return spark.read.parquet(path).select(*COLUMNS)


def newest_stored_date(spark: SparkSession, path: str) -> date | None:
    """One value, from the stored metric's partition column."""
    return spark.read.parquet(path).agg(F.max("event_date")).first()[0]


def build_metric(tables: Tables, path: str, as_of: X.AsOf, lookback_days: int = rules.LOOKBACK_DAYS) -> None:
    write_by_date(daily_active(tables, as_of, lookback_days), path, CLUSTER)


def update_metric(spark: SparkSession, tables: Tables, path: str, as_of: X.AsOf,
                  lookback_days: int = rules.LOOKBACK_DAYS) -> date | None:
    """Recompute from the newest stored date on and replace exactly those partitions.

    Replacing whole dates needs no merge key, so re-running changes nothing.
    Events that arrive late for older dates are left to :func:`repair_metric`.
    """
    newest = newest_stored_date(spark, path)
    since = None if newest is None else F.lit(newest)
    write_by_date(daily_active(tables, as_of, lookback_days, since), path, CLUSTER)
    return newest


def repair_metric(tables: Tables, path: str, as_of: X.AsOf, manifest: DataFrame | None = None) -> None:
    """Recompute and replace the dates of the reprocessing manifest, and no others.

    A date is recomputed for all products: its cross-product total depends on
    each. However old a flagged date is, it is repaired: the manifest's first and
    last date bound the scan, not the lookback.
    """
    manifest = manifest if manifest is not None else reprocessing_manifest(with_lag(tables.events))
    dates = settle(dates_to_reprocess(manifest), "dates")
    first, last = dates.agg(F.min("event_date"), F.max("event_date")).first()
    if first is not None:
        dated = events_on(tables, dates, first, last)
        write_by_date(daily_active(dated, as_of, None), path, CLUSTER)
