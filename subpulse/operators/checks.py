"""Column tests: each returns what fails, so an empty result is a pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null_failures(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def unique_failures(df: DataFrame, col: str) -> DataFrame:
    """Values that occur more than once; NULL is not a value."""
    return df.dropna(subset=[col]).groupBy(col).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def accepted_values_failures(df: DataFrame, col: str, allowed: Sequence) -> DataFrame:
    """Values outside the list with their row count; NULL passes."""
    return df.filter(_outside_values(col, allowed)).groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def accepted_range_failures(df: DataFrame, col: str, low, high) -> DataFrame:
    """Rows outside the closed range; NULL passes."""
    return df.filter(_outside_range(col, low, high))


def _outside_values(col: str, allowed: Sequence) -> Column:
    return F.col(col).isNotNull() & ~F.col(col).isin(list(allowed))


def _outside_range(col: str, low, high) -> Column:
    return ~F.col(col).between(low, high)


def run_column_tests(relations: dict[str, DataFrame | tuple[DataFrame, str, str]], tests: Sequence[tuple]) -> DataFrame:
    """(relation, column_name, test, failures) for declared (relation, column, test, argument) rows.

    A relation is a frame or, as (frame, key column, key), some rows of one.
    Relations of the same frame share their passes: one for all row-level tests,
    and one for each column that is to be unique.
    """
    by_frame: dict[int, tuple[DataFrame, str | None, dict[str, str | None]]] = {}
    for name, relation in relations.items():
        df, key, value = relation if isinstance(relation, tuple) else (relation, None, None)
        by_frame.setdefault(id(df), (df, key, {}))[2][name] = value
    results = []
    for df, key, named in by_frame.values():
        own = [t for t in tests if t[0] in named]

        def of(name: str, cond: Column, key=key, named=named) -> Column:
            return cond if key is None else (F.col(key) == named[name]) & cond

        rowwise = [t for t in own if t[2] != "unique"]
        if rowwise:
            results.append(_unpivoted(df, [(*t[:3], of(t[0], _failing(*t[1:]))) for t in rowwise]))
        for col in dict.fromkeys(t[1] for t in own if t[2] == "unique"):
            repeated = (df.dropna(subset=[col]).groupBy(*([key] if key else []), col).agg(F.count(F.lit(1)).alias("_n"))
                        .filter("_n > 1"))
            results.append(_unpivoted(repeated, [(*t[:3], of(t[0], F.lit(True))) for t in own
                                                 if t[1:3] == (col, "unique")]))
    return reduce(DataFrame.unionByName, results)


def _failing(col: str, test: str, arg) -> Column:
    if test == "not_null":
        return F.col(col).isNull()
    return _outside_values(col, arg) if test == "accepted_values" else _outside_range(col, *arg)


def _unpivoted(df: DataFrame, counted: list[tuple[str, str, str, Column]]) -> DataFrame:
    """One row per (relation, column, test, condition), with the rows of ``df`` that meet the condition."""
    slots = [F.struct(*_named(*c[:3]), F.col(f"t{i}").alias("failures")) for i, c in enumerate(counted)]
    return df.agg(*[F.count_if(c[3]).alias(f"t{i}") for i, c in enumerate(counted)]).select(F.inline(F.array(*slots)))


def _named(relation: str, col: str, test: str) -> list[Column]:
    return [F.lit(relation).alias("relation"), F.lit(col).alias("column_name"), F.lit(test).alias("test")]
