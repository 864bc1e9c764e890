"""Schema drift: live schemas and enumerations against the registry."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subpulse import rules
from subpulse.functions.expressions import keyed
from subpulse.functions.local import constant_table
from subpulse.sources.footers import open_footer

EVENT_COLUMNS = ["dataset", "column_name", "drift_type", "severity", "expected", "actual", "detail"]


class SchemaDriftError(RuntimeError):
    """Raised by :func:`drift_gate`."""


def registry_table(spark: SparkSession, registry: dict[str, list[tuple]] | None = None) -> DataFrame:
    rows = [(dataset, *column) for dataset, columns in (registry or rules.REGISTRY).items() for column in columns]
    return constant_table(spark, {"dataset": "string", "column_name": "string", "dtype": "string",
                                  "nullable": "boolean", "breaking": "boolean"}, rows)


def live_table(spark: SparkSession, schemas: dict[str, T.StructType]) -> DataFrame:
    """Columns of the live schemas. Reads no data."""
    rows = [(name, f.name, f.dataType.simpleString()) for name, schema in schemas.items() for f in schema.fields]
    return constant_table(spark, {"dataset": "string", "column_name": "string", "dtype": "string"}, rows)


def _event(drift_type: str, severity: Column, expected: Column, actual: Column, detail: Column) -> Column:
    return F.struct(F.lit(drift_type).alias("drift_type"), severity.alias("severity"), expected.alias("expected"),
                    actual.alias("actual"), detail.alias("detail"))


def column_drift(spark: SparkSession, schemas: dict[str, T.StructType],
                 registry: dict[str, list[tuple]] | None = None) -> DataFrame:
    """Missing, retyped and new columns: one full outer join of registry and live columns."""
    known = registry_table(spark, {d: (registry or rules.REGISTRY)[d] for d in schemas}).withColumnsRenamed(
        {"dtype": "expected_type"}).withColumn("registered", F.lit(True))
    live = live_table(spark, schemas).withColumnsRenamed({"dtype": "actual_type"}).withColumn("live", F.lit(True))
    both = known.join(live, ["dataset", "column_name"], "full")
    expected, actual = F.col("expected_type"), F.col("actual_type")
    tolerated = reduce(lambda a, b: a | b,
                       [(expected == e) & (actual == a) for e, a in rules.TOLERATED_TYPE_CHANGES], F.lit(False))
    missing = _event("MISSING_COLUMN", F.when(F.col("breaking"), "BREAKING").otherwise("WARNING"), expected, actual,
                     F.format_string("Column '%s' is no longer delivered; it may have been renamed.", "column_name"))
    retyped = _event("TYPE_CHANGE", F.when(tolerated, "WARNING").otherwise("BREAKING"), expected, actual,
                     F.format_string("Type of '%s' changed from %s to %s.", "column_name", expected, actual))
    new = _event("NEW_COLUMN", F.lit("WARNING"), expected, actual,
                 F.format_string("Column '%s' is not in the registry; review and register it.", "column_name"))
    event = (F.when(F.col("live").isNull(), missing).when(F.col("registered").isNull(), new)
             .when(expected != actual, retyped))
    return (both.withColumn("event", event).filter(F.col("event").isNotNull())
            .select("dataset", "column_name", "event.*"))


def enum_violations(datasets: dict[str, DataFrame], enums: dict[str, tuple] | None = None,
                    by: Sequence[str] = ()) -> DataFrame | None:
    """Every value outside its registered list, with its row count; NULL is no violation.

    ``by`` adds grouping columns, such as the partition date. None when no
    dataset has a registered enumeration.
    """
    parts = []
    for name, (col, allowed, severity) in (enums or rules.REGISTRY_ENUMS).items():
        df = datasets.get(name)
        if df is None or col not in df.columns:
            continue
        bad = df.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(allowed)))
        parts.append(bad.groupBy(F.lit(name).alias("dataset"), F.lit(col).alias("column_name"),
                                 F.lit(severity).alias("severity"), F.col(col).alias("value"), *by)
                     .agg(F.count(F.lit(1)).alias("n")))
    return reduce(DataFrame.unionByName, parts) if parts else None


def enum_drift(violations: DataFrame) -> DataFrame:
    """One event per column with unknown values: how many, in how many rows.

    The values themselves stay rows of :func:`enum_violations`, which holds them all.
    """
    keys = ["dataset", "column_name", "severity"]
    per_value = violations.groupBy(*keys, "value").agg(F.sum("n").alias("n"))
    counted = per_value.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_values"), F.sum("n").alias("n_rows"))
    detail = F.format_string("Unknown values of '%s': %d, in %d rows; the table of unknown values has them all.",
                             "column_name", "n_values", "n_rows")
    absent = F.lit(None).cast("string")
    return counted.select(
        "dataset", "column_name", F.lit("ENUM_VIOLATION").alias("drift_type"), "severity", absent.alias("expected"),
        absent.alias("actual"), detail.alias("detail"))


def detect_drift(datasets: dict[str, DataFrame], registry: dict[str, list[tuple]] | None = None,
                 enums: dict[str, tuple] | None = None) -> DataFrame:
    """All drift events of the datasets. Only enumerated columns are read."""
    spark = next(iter(datasets.values())).sparkSession
    events = column_drift(spark, {n: df.schema for n, df in datasets.items()}, registry)
    violations = enum_violations(datasets, enums)
    return events if violations is None else events.unionByName(enum_drift(violations))


def drift_status(events: DataFrame, datasets: Sequence[str]) -> DataFrame:
    """(dataset, status, events) for every dataset; the worst severity wins."""
    every = constant_table(events.sparkSession, {"dataset": "string"}, [(d,) for d in datasets])
    ranked = events.groupBy("dataset").agg(
        F.max(keyed(F.col("severity"), rules.SEVERITY_RANK, 0)).alias("rank"), F.count(F.lit(1)).alias("events"))
    status = keyed(F.coalesce(F.col("rank"), F.lit(0)), {r: s for s, r in rules.SEVERITY_RANK.items()})
    return every.join(ranked, "dataset", "left").select(
        "dataset", status.alias("status"), F.coalesce("events", F.lit(0)).alias("events"))


def drift_summary(status: DataFrame) -> DataFrame:
    return status.agg(
        F.count(F.lit(1)).alias("total_datasets"),
        *[F.count_if(F.col("status") == s).alias(s.lower()) for s in ("CLEAN", "INFO", "WARNING", "BREAKING")],
        F.sum("events").alias("total_events"))


def drift_gate(status: DataFrame) -> None:
    """Stop on any BREAKING dataset. The status table has one row per dataset."""
    broken = sorted(r.dataset for r in status.filter("status = 'BREAKING'").select("dataset").collect())
    if broken:
        raise SchemaDriftError(f"breaking schema drift: {', '.join(broken)}")


def drift_gates(status: DataFrame) -> DataFrame:
    """What the gate decides, a row per dataset: (dataset, status, halts)."""
    return status.select("dataset", "status", (F.col("status") == "BREAKING").alias("halts"))


def column_counts(spark: SparkSession, schemas: dict[str, T.StructType],
                  registry: dict[str, list[tuple]] | None = None) -> DataFrame:
    """(dataset, columns_expected, columns_found) for the header of a report."""
    known = registry or rules.REGISTRY
    return constant_table(spark, {"dataset": "string", "columns_expected": "bigint", "columns_found": "bigint"},
                          [(name, len(known[name]), len(schema.fields)) for name, schema in schemas.items()])


def column_presence(df: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """(*by, column_name, dtype, n_rows, n_filled) per group and column, from the rows themselves.

    A schema covers all files of a table; a column that newer files or single
    partitions no longer fill only shows in their rows. Group by the partition's
    date or by ``_metadata.file_name``. One pass, combined on the map side.
    """
    names = [c for c in columns or df.columns if c not in by]
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"),
                                 *[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(names)])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                               F.col("_n").alias("n_rows"), F.col(f"_{i}").alias("n_filled"))
                      for i, c in enumerate(names)])
    return counts.select(*by, F.inline(cells))


#: Spark's names of the types that Parquet files have; decimals, lists, maps and structs are put together from them.
_SPARK_TYPES = {
    "bool": "boolean", "int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "float": "float",
    "double": "double", "string": "string", "large_string": "string", "binary": "binary", "large_binary": "binary",
    "date32[day]": "date", "uint8": "smallint", "uint16": "int", "uint32": "bigint", "uint64": "decimal(20,0)",
}


def spark_type(dtype: pa.DataType) -> str:
    """The type that Spark reads a column of this file type as."""
    if pa.types.is_timestamp(dtype):
        return "timestamp" if dtype.tz else "timestamp_ntz"
    if pa.types.is_decimal(dtype):
        return f"decimal({dtype.precision},{dtype.scale})"
    if pa.types.is_map(dtype):
        return f"map<{spark_type(dtype.key_type)},{spark_type(dtype.item_type)}>"
    if pa.types.is_list(dtype) or pa.types.is_large_list(dtype):
        return f"array<{spark_type(dtype.value_type)}>"
    if pa.types.is_struct(dtype):
        return f"struct<{','.join(f'{f.name}:{spark_type(f.type)}' for f in dtype)}>"
    return _SPARK_TYPES.get(str(dtype), str(dtype))


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths of Parquet files -> a row per file and column. Reads footers only."""
    for batch in batches:
        out: list[tuple[str, str, str, int]] = []
        for path in batch.column(0).to_pylist():
            footer = open_footer(path)
            out += [(path, f.name, spark_type(f.type), footer.num_rows) for f in footer.schema.to_arrow_schema()]
        columns = list(zip(*out, strict=True)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()),
                                          pa.array(columns[2], pa.string()), pa.array(columns[3], pa.int64())],
                                         ["file", "column_name", "dtype", "n_rows"])


def file_schemas(spark: SparkSession, *paths: str) -> DataFrame:
    """(file, column_name, dtype, n_rows) of every Parquet file below the paths, as each file itself declares it.

    Spark lists the files and deals them out; tasks read their footers. Neither
    the files nor their schemas pass through the driver, and no two files need to
    agree, where a read of the table would take the first one's types or fail.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
        "recursiveFileLookup", True).load(list(paths)).select("path")  # without the content, which stays unread
    dealt = listed.repartition(F.xxhash64("path"))
    return dealt.mapInArrow(_footers, "file string, column_name string, dtype string, n_rows long")


def file_drift(schemas: DataFrame, registry: list[tuple]) -> DataFrame:
    """Missing, retyped and new columns per file against one dataset's registered columns.

    Every file is written out with the registered columns and joined with its own
    by (file, column): what either side lacks, or has otherwise, is an event.
    """
    columns = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("expected"), F.lit(b).alias("breaking"))
                        for c, t, _, b in registry])
    wanted = schemas.select("file").distinct().select("file", F.inline(columns))
    both = wanted.join(schemas.withColumnRenamed("dtype", "actual"), ["file", "column_name"], "full")
    tolerated = reduce(lambda a, b: a | b, [(F.col("expected") == e) & (F.col("actual") == a)
                                            for e, a in rules.TOLERATED_TYPE_CHANGES], F.lit(False))
    kind = (F.when(F.col("actual").isNull(), "MISSING_COLUMN").when(F.col("expected").isNull(), "NEW_COLUMN")
            .when(F.col("expected") != F.col("actual"), "TYPE_CHANGE"))
    severity = (F.when(F.col("actual").isNull(), F.when(F.col("breaking"), "BREAKING").otherwise("WARNING"))
                .when(F.col("expected").isNull() | tolerated, "WARNING").otherwise("BREAKING"))
    return both.withColumns({"drift_type": kind, "severity": severity}).filter("drift_type IS NOT NULL").select(
        "file", "column_name", "drift_type", "severity", "expected", "actual")


def file_conflicts(schemas: DataFrame) -> DataFrame:
    """(column_name, dtype, n_files, n_rows) of every column that files disagree on, a row per type."""
    types = schemas.groupBy("column_name", "dtype").agg(F.count(F.lit(1)).alias("n_files"), F.sum("n_rows").alias("n_rows"))
    several = types.groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("column_name")
    return types.join(several, "column_name")


def latest_days(df: DataFrame, date_col: str, days: int = 1) -> DataFrame:
    """Rows of the newest ``days`` dates, so a daily check reads only the newest partitions."""
    newest = df.agg(F.max(date_col)).scalar()
    return df.filter(F.col(date_col) > F.date_sub(newest, days))
