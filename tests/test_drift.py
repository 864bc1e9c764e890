"""The four injected drift scenarios must give five events, a clean run none."""

import pytest
from pyspark.sql import functions as F

from subpulse import rules
from subpulse.operators import drift
from subpulse.sources.readers import registered_schema


@pytest.fixture(scope="module")
def clean(spark):
    return {name: spark.createDataFrame([], registered_schema(name)) for name in rules.REGISTRY}


@pytest.fixture(scope="module")
def injected(spark, clean):
    plans = spark.createDataFrame([("audio_only",), ("bundle_all",), (None,)], "plan_type string")
    subs = plans.select(*[F.col(c) if c == "plan_type" else F.lit(None).cast(t).alias(c)
                          for c, t, _, _ in rules.REGISTRY["subscribers"]])
    return {
        **clean,
        "events_games": clean["events_games"].withColumnRenamed("game_name", "game_title"),
        "events_athletic": clean["events_athletic"].withColumn("time_on_page_sec", F.lit(0).cast("bigint")),
        "events_news": clean["events_news"].withColumn("scroll_depth_pct", F.lit(0.0)),
        "subscribers": subs,
    }


def test_clean_run(clean):
    events = drift.detect_drift(clean)
    status = drift.drift_status(events, list(clean))
    assert events.count() == 0
    assert {r.status for r in status.collect()} == {"CLEAN"}
    drift.drift_gate(status)


def test_injected_drift(injected, rows):
    events = drift.detect_drift(injected)
    assert rows(events.drop("detail")) == sorted([
        ("events_games", "game_name", "MISSING_COLUMN", "BREAKING", "string", None),
        ("events_games", "game_title", "NEW_COLUMN", "WARNING", None, "string"),
        ("events_athletic", "time_on_page_sec", "TYPE_CHANGE", "BREAKING", "double", "bigint"),
        ("events_news", "scroll_depth_pct", "NEW_COLUMN", "WARNING", None, "double"),
        ("subscribers", "plan_type", "ENUM_VIOLATION", "BREAKING", None, None)], key=str)
    assert events.filter("drift_type = 'ENUM_VIOLATION'").first().detail.startswith("Unknown values of 'plan_type': 1, in 1 ")
    status = drift.drift_status(events, list(injected))
    assert drift.drift_summary(status).first().asDict() == {
        "total_datasets": 5, "clean": 1, "info": 0, "warning": 1, "breaking": 3, "total_events": 5}
    with pytest.raises(drift.SchemaDriftError, match="events_athletic, events_games, subscribers"):
        drift.drift_gate(status)


@pytest.mark.parametrize("column, to, severity", [
    ("score", "double", "WARNING"), ("duration_sec", "float", "WARNING"),
    ("duration_sec", "bigint", "BREAKING"), ("score", "int", "BREAKING")])
def test_type_changes(clean, column, to, severity):
    games = clean["events_games"].withColumn(column, F.col(column).cast(to))
    event = drift.detect_drift({"events_games": games}).first()
    assert (event.drift_type, event.severity, event.actual) == ("TYPE_CHANGE", severity, to)


def test_missing_optional_column_only_warns(clean):
    event = drift.detect_drift({"events_news": clean["events_news"].drop("section")}).first()
    assert (event.drift_type, event.severity) == ("MISSING_COLUMN", "WARNING")


def test_many_unknown_values_stay_whole_in_the_table(spark):
    games = spark.range(50).selectExpr("concat('game_', lpad(id % 45, 2, '0')) AS game_name")
    found = drift.enum_violations({"events_games": games})
    assert found.count() == 45 and found.agg(F.sum("n")).first()[0] == 50
    detail = drift.enum_drift(found).first().detail
    assert detail == "Unknown values of 'game_name': 45, in 50 rows; the table of unknown values has them all."


def test_latest_days(spark):
    df = spark.sql("SELECT DATE '2024-01-01' + CAST(id AS INT) AS d FROM range(10)")
    assert drift.latest_days(df, "d", 3).count() == 3


def test_files_that_disagree_on_a_type(spark, tmp_path, rows):
    """Read as one table they fail or take the first one's types; their footers tell each file's own."""
    folder = f"file://{tmp_path}/orders"
    registry = [("id", "bigint", False, True), ("price", "double", True, True), ("note", "string", True, False)]
    parts = ["SELECT 1L AS id, 2.5D AS price, 'x' AS note", "SELECT 1 AS id, 2.5D AS price, 'x' AS note",
             "SELECT 1L AS id, CAST(2.5 AS FLOAT) AS price, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS extra",
             "SELECT 1L AS id, CAST(2.5 AS DECIMAL(9,2)) AS price, array(1, 2) AS note"]
    for i, sql in enumerate(parts):
        spark.sql(sql).coalesce(1).write.parquet(f"{folder}/day={i}")
    schemas = drift.file_schemas(spark, folder).withColumn("file", F.regexp_extract("file", r"day=(\d)", 1)).cache()
    assert schemas.filter("file = 2").count() == 3 and schemas.agg(F.sum("n_rows")).first()[0] == 12
    assert rows(drift.file_drift(schemas, registry)) == sorted([
        ("1", "id", "TYPE_CHANGE", "BREAKING", "bigint", "int"), ("2", "price", "TYPE_CHANGE", "WARNING", "double", "float"),
        ("2", "extra", "NEW_COLUMN", "WARNING", None, "timestamp_ntz"),
        ("2", "note", "MISSING_COLUMN", "WARNING", "string", None),
        ("3", "price", "TYPE_CHANGE", "BREAKING", "double", "decimal(9,2)"),
        ("3", "note", "TYPE_CHANGE", "BREAKING", "string", "array<int>")], key=str)
    assert rows(drift.file_conflicts(schemas)) == sorted([
        ("id", "bigint", 3, 3), ("id", "int", 1, 1), ("price", "double", 2, 2), ("price", "float", 1, 1),
        ("price", "decimal(9,2)", 1, 1), ("note", "string", 2, 2), ("note", "array<int>", 1, 1)], key=str)
