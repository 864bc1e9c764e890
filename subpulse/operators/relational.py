"""Small generic operators that take column names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The first row of each key. Remaining columns break ties, so the pick is repeatable.

    Spark cuts each map partition to one row per key before it shuffles
    (WindowGroupLimit), so a key that owns most rows does not burden one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in [*order_by, *rest]])
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def value_counts(df: DataFrame, *cols: str, name: str = "n") -> DataFrame:
    """Rows per value, NULL values left out."""
    return df.dropna(subset=list(cols)).groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def most_frequent(df: DataFrame, col: str, k: int, name: str = "n") -> DataFrame:
    """The k most frequent values; equal counts are ordered by value."""
    return value_counts(df, col, name=name).orderBy(F.desc(name), F.asc(col)).limit(k)


def membership_counts(df: DataFrame, fk: str, ref: DataFrame, ref_col: str,
                      by: Sequence[str] = ()) -> DataFrame:
    """Rows, matched, orphaned and NULL-key rows of ``df`` against ``ref``.

    Rows are counted per key before the join. The join then sees each key once
    per group, however many rows a single key (or NULL) owns.
    """
    per_key = df.groupBy(*by, F.col(fk).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    known = ref.select(F.col(ref_col).alias("_key")).dropna().distinct().withColumn("_known", F.lit(True))
    joined = per_key.join(known, "_key", "left")
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("_n"))), F.lit(0))
    return joined.groupBy(*by).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
        total(F.col("_known")).alias("matched"),
        total(F.col("_known").isNull() & F.col("_key").isNotNull()).alias("orphans"),
        total(F.col("_key").isNull()).alias("nulls"),
    )


def rows_with_key(df: DataFrame, fk: str, ref: DataFrame, ref_col: str) -> DataFrame:
    """Rows whose key is in ``ref``."""
    return df.join(ref.select(F.col(ref_col).alias(fk)).distinct(), fk, "left_semi")


def rows_without_key(df: DataFrame, fk: str, ref: DataFrame, ref_col: str) -> DataFrame:
    """Rows whose key is NULL or not in ``ref``."""
    known = ref.select(F.col(ref_col).alias(fk)).dropna().distinct()
    return df.join(known, fk, "left_anti")


def group_rate(df: DataFrame, by: str, flag: Column, digits: int = 1) -> DataFrame:
    """Rows, flagged rows and flagged percentage per value of ``by``."""
    out = df.dropna(subset=[by]).groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(flag).alias("flagged"))
    return out.withColumn("rate", F.round(F.col("flagged") / F.col("n") * F.lit(100.0), digits))


def trailing_days(df: DataFrame, date_col: str, newest: DataFrame, days: int) -> DataFrame:
    """Rows dated on or after (newest date - days); ``newest`` is one row, one column.

    The one-row frame is a scalar: an ungrouped aggregate, whatever the data.
    """
    cutoff = newest.select(F.date_sub(F.col(newest.columns[0]), days)).scalar()
    return df.filter(F.col(date_col) >= cutoff)
