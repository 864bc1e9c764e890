"""Constant tables held in the plan."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_ARROW = {"string": pa.string(), "boolean": pa.bool_(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64()}


def constant_table(spark: SparkSession, columns: dict[str, str], rows: Sequence[tuple]) -> DataFrame:
    """A small literal table. Its size is known to the planner, which may broadcast it unhinted."""
    arrays = [pa.array([row[i] for row in rows], type=_ARROW[dtype]) for i, dtype in enumerate(columns.values())]
    return spark.createDataFrame(pa.table(arrays, names=list(columns)))
