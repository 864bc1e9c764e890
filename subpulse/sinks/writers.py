"""Writing tables, reports and asset metadata."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from subpulse.functions.local import constant_table


def write_counted(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Overwrite ``path`` and return the rows written, counted while writing."""
    observed = Observation()
    df.observe(observed, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(fmt).save(path)
    return int(observed.get["rows"])


def full_refresh(spark: SparkSession, sources: dict[str, DataFrame | None], target: str) -> DataFrame:
    """Replace every target table; an absent source is skipped. (table, status, rows)."""
    rows = []
    for name, df in sources.items():
        if df is None:
            rows.append((name, "skipped", 0))
        else:
            rows.append((name, "loaded", write_counted(df, f"{target.rstrip('/')}/{name}")))
    return constant_table(spark, {"table_name": "string", "status": "string", "rows": "bigint"}, rows)


def create_or_replace_table(df: DataFrame, database: str, table: str, location: str | None = None) -> str:
    """Create the database if needed (below ``location``) and replace the table with the query's result."""
    place = f" LOCATION '{location.rstrip('/')}/{database}'" if location else ""
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    writer = df.write.mode("overwrite").format("parquet")
    if location:
        writer = writer.option("path", f"{location.rstrip('/')}/{database}/{table}")
    writer.saveAsTable(f"{database}.{table}")
    return f"{database}.{table}"


def create_view(df: DataFrame, name: str) -> str:
    df.createOrReplaceTempView(name)
    return name


def write_by_date(df: DataFrame, path: str, cluster_by: Sequence[str] = (), date_col: str = "event_date") -> None:
    """Replace only the date partitions present in ``df``.

    Rows are rebalanced by date: AQE splits a date that is too large for one
    task and packs small dates together, then each file is sorted.
    """
    (df.hint("rebalance", date_col).sortWithinPartitions(date_col, *cluster_by)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_col).parquet(path))


def write_json_report(df: DataFrame, path: str) -> None:
    """A report as JSON lines; NULL fields are kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def as_json(df: DataFrame, name: str = "report") -> DataFrame:
    """Each row as one JSON text."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(name))


def asset_metadata(assets: dict[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """(asset, row_count, freshest) per asset, given its table and freshness column."""
    parts = [
        df.agg(F.lit(name).alias("asset"), F.count(F.lit(1)).alias("row_count"),
               (F.max(F.col(ts).try_cast("timestamp_ntz")) if ts else F.lit(None).cast("timestamp_ntz"))
               .alias("freshest"))
        for name, (df, ts) in assets.items()
    ]
    return reduce(DataFrame.unionByName, parts)
