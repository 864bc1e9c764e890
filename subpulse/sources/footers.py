"""Facts of stored Parquet tables from their footers: rows and newest value, with no column read."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FACTS = "file string, n_rows long, newest timestamp_ntz, is_known boolean"


def open_footer(path: str):
    """The footer of a Parquet file, by a file system of Arrow's that its URI names. Runs in tasks."""
    import pyarrow.fs as stores
    import pyarrow.parquet as pq

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    store, inside = stores.FileSystem.from_uri(path)
    with store.open_input_file(inside) as file:
        return pq.read_metadata(file)


def _facts(column: str | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_rows, newest, known = [], [], []
            for path in batch.column(0).to_pylist():
                footer = open_footer(path)
                place = footer.schema.names.index(column) if column in footer.schema.names else None
                values, whole = [], place is not None
                for group in map(footer.row_group, range(footer.num_row_groups)) if whole else ():
                    cells = group.column(place)
                    stats = cells.statistics if cells.is_stats_set else None
                    if stats is not None and stats.has_min_max:
                        value = stats.max
                        values.append(value if isinstance(value, datetime) else datetime(value.year, value.month, value.day))
                    elif stats is None or not stats.has_null_count or stats.null_count < group.num_rows:
                        whole = False  # values without statistics: only a scan knows
                n_rows.append(footer.num_rows)
                newest.append(max(values) if values and whole else None)
                known.append(whole)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_rows, pa.int64()), pa.array(newest, pa.timestamp("us")),
                 pa.array(known, pa.bool_())], ["file", "n_rows", "newest", "is_known"])

    return run


def file_facts(spark: SparkSession, path: str, column: str | None = None) -> DataFrame:
    """(file, n_rows, newest, is_known) of each Parquet file below ``path``; ``column`` is a date or timestamp.

    ``is_known`` is false where the file lacks the column or statistics of it.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
        "recursiveFileLookup", True).load(path).select("path")  # the content stays unread
    return listed.repartition(F.xxhash64("path")).mapInArrow(_facts(column), FACTS)


def stored_metadata(spark: SparkSession, assets: dict[str, tuple[str, str | None]]) -> DataFrame:
    """(asset, row_count, freshest, is_known) per stored table, given its path and freshness column.

    ``freshest`` is exact where ``is_known``; where a file has no statistics it is
    NULL, and :func:`subpulse.sinks.writers.asset_metadata` scans the table instead.
    """
    parts = []
    for name, (path, column) in assets.items():
        every = F.coalesce(F.every("is_known"), F.lit(False))
        parts.append(file_facts(spark, path, column).agg(
            F.lit(name).alias("asset"), F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long").alias("row_count"),
            F.when(every, F.max("newest")).alias("freshest"), every.alias("is_known")))
    return reduce(DataFrame.unionByName, parts)
