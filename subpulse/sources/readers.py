"""File sources with declared schemas, and the logical-name registry over them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from subpulse.rules import REGISTRY


def registered_schema(dataset: str) -> T.StructType:
    """The declared schema of a registered dataset, so no read has to infer one."""
    return T.StructType.fromDDL(", ".join(
        f"{name} {dtype}{'' if nullable else ' NOT NULL'}" for name, dtype, nullable, _ in REGISTRY[dataset]))


#: What a declared column holds that is not of its type: the cell's column and text.
RESCUED = "array<struct<column_name: string, cell: string>>"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, keep_extra: bool = False,
             rescued: str | None = None) -> DataFrame:
    """CSV with a header: the declared columns, found by name and cast; text that does not parse is NULL.

    Only the header is read ahead, no type is inferred. A declared column that
    the file lacks is an error. With ``keep_extra`` undeclared columns follow as
    text, so that a drift check sees them. With ``rescued`` a column of that name
    holds every cell of the row that has a text but no value of its type, as
    (column_name, cell); it is empty for a row that parses.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    missing = [f.name for f in declared if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    extra = [c for c in raw.columns if c not in declared.names] if keep_extra else []
    typed = [_quoted(f.name).try_cast(f.dataType).alias(f.name) for f in declared]
    lost = [F.when(_quoted(f.name).isNotNull() & _quoted(f.name).try_cast(f.dataType).isNull(),
                   F.struct(F.lit(f.name).alias("column_name"), _quoted(f.name).alias("cell"))) for f in declared]
    beside = [F.array_compact(F.array(*lost)).cast(RESCUED).alias(rescued)] if rescued else []
    return raw.select(*typed, *map(_quoted, extra), *beside)


def unparsed_cells(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """(file, column_name, cell, n_rows): every text that does not parse, by file, with how many rows have it.

    One pass over the text, combined on the map side; the typed columns are not built.
    """
    cells = read_csv(spark, path, schema, rescued="_rescued").select(
        F.col("_metadata.file_path").alias("file"), F.inline("_rescued"))
    return cells.groupBy("file", "column_name", "cell").agg(F.count(F.lit(1)).alias("n_rows"))


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


@dataclass(frozen=True)
class SourceRegistry:
    """Logical table name -> file, below one root, with an optional dirty variant.

    ``files`` maps a name to (relative path, format). The ``dirty`` variant of a
    file sits next to it with ``_dirty`` before the extension; a table without
    one is read from its only file.
    """

    root: str
    files: dict[str, tuple[str, str]]
    dirty: frozenset[str] = field(default_factory=frozenset)

    def path(self, name: str, variant: str = "clean") -> str:
        relative, _ = self.files[name]
        if variant == "dirty" and name in self.dirty:
            stem, dot, extension = relative.rpartition(".")
            relative = f"{stem}_dirty{dot}{extension}"
        elif variant not in ("clean", "dirty"):
            raise ValueError(f"unknown variant {variant!r}")
        return f"{self.root.rstrip('/')}/{relative}"

    def read(self, spark: SparkSession, name: str, variant: str = "clean",
             schema: T.StructType | str | None = None) -> DataFrame:
        fmt = self.files[name][1]
        path = self.path(name, variant)
        if fmt == "csv":
            return read_csv(spark, path, schema or registered_schema(name))
        return read_parquet(spark, path, schema)

    def read_if_present(self, spark: SparkSession, name: str, variant: str = "clean",
                        schema: T.StructType | str | None = None) -> DataFrame | None:
        """None when the file is absent; any other failure is raised."""
        try:
            return self.read(spark, name, variant, schema)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def create_views(self, spark: SparkSession, prefix: str = "raw_", variant: str = "clean") -> list[str]:
        """Register every named source as a temporary view."""
        names = []
        for name in self.files:
            view = f"{prefix}{name}"
            self.read(spark, name, variant).createOrReplaceTempView(view)
            names.append(view)
        return names


# --- Fixed values: where the raw files lie ----------------------------------
LANDING_FILES = {
    "subscribers": ("subscribers/subscribers.csv", "csv"),
    "events_news": ("news/events.parquet", "parquet"),
    "events_games": ("games/events.parquet", "parquet"),
    "events_cooking": ("cooking/events.parquet", "parquet"),
    "events_athletic": ("athletic/events.parquet", "parquet"),
}
LANDING_DIRTY = frozenset({"subscribers", "events_news", "events_games"})


def landing_registry(root: str) -> SourceRegistry:
    return SourceRegistry(root, LANDING_FILES, LANDING_DIRTY)
