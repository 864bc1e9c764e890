import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from subpulse.functions import expressions as X
from subpulse.operators import drift
from subpulse.plans import maintenance
from subpulse.plans.daily_active import daily_active
from subpulse.queries import AS_OF, FIRST_LOAD
from subpulse.session import scratch_path, shared_dir
from subpulse.sinks import writers
from subpulse.sources import Tables, from_registry, read_parquet
from subpulse.sources.readers import landing_registry, read_csv, registered_schema, unparsed_cells


@pytest.fixture
def path(tmp_path):
    return f"file://{tmp_path}/metric"


def files(path):
    return {p.parent.name: p.stat().st_mtime_ns for p in Path(path.removeprefix("file://")).glob("*/*.parquet")}


def before(tables, moment):
    return Tables(tables.subscribers, tables.events.filter(F.col("arrival_ts") < X.as_of_ts(moment)), tables.columns)


def test_an_increment_rewrites_only_new_dates_and_repeats_without_effect(spark, tables, path, rows):
    maintenance.build_metric(before(tables, FIRST_LOAD), path, FIRST_LOAD)
    first = files(path)
    newest = maintenance.update_metric(spark, tables, path, AS_OF)
    assert str(newest) == "2024-01-19"
    second = files(path)
    assert all(second[d] == first[d] for d in first if d < "event_date=2024-01-19")
    assert second["event_date=2024-01-19"] != first["event_date=2024-01-19"]
    kept = rows(maintenance.read_metric(spark, path))
    maintenance.update_metric(spark, tables, path, AS_OF)
    assert rows(maintenance.read_metric(spark, path)) == kept


def test_a_repair_touches_only_the_given_dates(spark, tables, path):
    maintenance.build_metric(before(tables, FIRST_LOAD), path, AS_OF)
    first = files(path)
    manifest = spark.sql("SELECT 'events_news' AS domain, DATE '2024-01-05' AS event_date")
    maintenance.repair_metric(tables, path, AS_OF, manifest=manifest)
    second = files(path)
    assert {d for d in second if second[d] != first.get(d)} == {"event_date=2024-01-05"}
    stored = maintenance.read_metric(spark, path).filter("event_date = DATE '2024-01-05'")
    full = daily_active(tables, AS_OF).filter("event_date = DATE '2024-01-05'")
    assert stored.exceptAll(full).count() == 0 and full.exceptAll(stored).count() == 0


def test_a_repair_reaches_dates_before_the_lookback(spark, tables, path):
    """A date 120 days back, stored without its late events, and one in between that nobody flagged."""
    old = tables.events.withColumn("event_timestamp", F.expr("event_timestamp - INTERVAL '110' DAY"))
    moved = Tables(tables.subscribers, old, tables.columns)
    on_time = Tables(tables.subscribers, old.filter("event_id % 2 = 0"), tables.columns)
    writers.write_by_date(daily_active(on_time, AS_OF, None), path, maintenance.CLUSTER)
    first = files(path)
    manifest = spark.sql("SELECT 'events_news' AS domain, DATE '2023-09-20' AS event_date "
                         "UNION ALL SELECT 'events_games', DATE '2023-09-26'")
    maintenance.repair_metric(moved, path, AS_OF, manifest=manifest)
    changed = {d for d, stamp in files(path).items() if stamp != first.get(d)}
    assert changed == {"event_date=2023-09-20", "event_date=2023-09-26"}
    stored = maintenance.read_metric(spark, path).filter("event_date = DATE '2023-09-26'")
    full = daily_active(moved, AS_OF, None).filter("event_date = DATE '2023-09-26'")
    assert stored.exceptAll(full).isEmpty() and full.exceptAll(stored).isEmpty() and not full.isEmpty()
    maintenance.repair_metric(moved, path, AS_OF, manifest=manifest.limit(0))  # nothing flagged, nothing done


def test_csv_columns_are_found_by_name(spark, tables, tmp_path):
    path, subs = f"file://{tmp_path}/subs", tables.subscribers.filter("CAST(subscriber_id AS INT) <= 20")
    subs.select(*reversed(subs.columns)).withColumn("new col", F.lit("x")).write.option("header", True).csv(path)
    schema = registered_schema("subscribers")
    got = read_csv(spark, path, schema)
    assert got.columns == schema.names
    assert got.exceptAll(subs.select(*schema.names)).isEmpty()
    seen = read_csv(spark, path, schema, keep_extra=True)
    drifted = drift.column_drift(spark, {"subscribers": seen.schema}).collect()
    assert [(r.column_name, r.drift_type) for r in drifted] == [("new col", "NEW_COLUMN")]
    subs.drop("plan_type").write.option("header", True).csv(path + "-short")
    with pytest.raises(ValueError, match="plan_type"):
        read_csv(spark, path + "-short", schema)


def test_files_of_the_metric_are_sorted(spark, tables, path):
    maintenance.build_metric(tables, path, AS_OF)
    one_day = spark.read.parquet(f"{path}/event_date=2024-01-10").select("product", "bundle_tier").collect()
    assert [(r.product, r.bundle_tier or "") for r in one_day] == sorted((r.product, r.bundle_tier or "") for r in one_day)


def test_full_refresh_replaces_and_skips(spark, tmp_path):
    target = f"file://{tmp_path}/load"
    report = writers.full_refresh(spark, {"a": spark.range(5), "absent": None}, target)
    assert [tuple(r) for r in report.orderBy("table_name").collect()] == [("a", "loaded", 5), ("absent", "skipped", 0)]
    writers.full_refresh(spark, {"a": spark.range(2)}, target)
    assert read_parquet(spark, f"{target}/a").count() == 2


def test_registry_reads_both_variants(spark, tables, tmp_path):
    registry = landing_registry(f"file://{tmp_path}/landing")
    tables.subscribers.limit(10).write.option("header", True).csv(registry.path("subscribers"))
    tables.subscribers.limit(12).write.option("header", True).csv(registry.path("subscribers", "dirty"))
    for product in tables.columns:
        tables.product(product).write.parquet(registry.path(f"events_{product}"))
    assert registry.path("events_news", "dirty").endswith("news/events_dirty.parquet")
    assert registry.path("events_cooking", "dirty") == registry.path("events_cooking")
    assert registry.read(spark, "subscribers", "dirty").count() == 12
    assert registry.read_if_present(spark, "events_games", "dirty") is None
    with pytest.raises(ValueError):
        registry.path("subscribers", "filthy")
    loaded = from_registry(spark, registry)
    assert loaded.events.count() == tables.events.count()
    assert daily_active(loaded, AS_OF).filter("product = 'ALL_PRODUCTS'").count() == 30


def test_a_product_of_separate_tables_reads_one_table(tables):
    apart = Tables.of(tables.subscribers, {p: tables.product(p) for p in tables.columns})
    assert apart.product("games").columns == tables.product("games").columns
    plan = apart.product("games")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan


def test_json_report_keeps_nulls(spark, tmp_path):
    path = f"file://{tmp_path}/report"
    df = spark.sql("SELECT 'a' AS name, CAST(NULL AS DOUBLE) AS score, array('x') AS issues")
    writers.write_json_report(df, path)
    assert spark.read.text(path).first()[0] == '{"name":"a","score":null,"issues":["x"]}'
    assert writers.as_json(df).first()[0] == '{"name":"a","score":null,"issues":["x"]}'


def test_scratch_lies_in_the_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(shared_dir(spark) + "/scratch-")


def test_scratch_goes_with_the_driver(tmp_path):
    """A driver of its own settles a table and ends."""
    code = ("from subpulse.session import build_session, settle; import pathlib, sys; "
            f"spark = build_session('local[1]', 1, 'scratch', {{'spark.checkpoint.dir': 'file://{tmp_path}/shared'}}); "
            f"settle(spark.range(3)); assert list(pathlib.Path('{tmp_path}/shared').rglob('*.parquet'))")
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120, capture_output=True,
                   cwd=Path(__file__).resolve().parents[1])
    assert not list(tmp_path.rglob("*.parquet"))


def test_cells_that_do_not_parse_are_kept_beside_the_typed_columns(spark, tmp_path, rows):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "a.csv").write_text("id,price,when,more\n1,2.5,2024-01-02,x\nzwei,2.5,2024-01-02,y\n3,,,z\n")
    (folder / "b.csv").write_text('id,price,when,more\n4,"1,5",tomorrow,x\n5,"1,5",2024-13-01,y\n')
    schema = "id int, price double, when date"
    df = read_csv(spark, f"file://{folder}", schema, keep_extra=True, rescued="bad")
    assert df.columns == ["id", "price", "when", "more", "bad"]
    got = {r.id: [tuple(c) for c in r.bad] for r in df.collect()}
    assert got == {1: [], None: [("id", "zwei")], 3: [], 4: [("price", "1,5"), ("when", "tomorrow")],
                   5: [("price", "1,5"), ("when", "2024-13-01")]}
    assert rows(unparsed_cells(spark, f"file://{folder}", schema).withColumn("file", F.regexp_extract("file", "[^/]+$", 0))) \
        == sorted([("a.csv", "id", "zwei", 1), ("b.csv", "price", "1,5", 2), ("b.csv", "when", "tomorrow", 1),
                   ("b.csv", "when", "2024-13-01", 1)], key=str)


def test_metadata_from_footers_says_where_it_does_not_know(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    from datetime import datetime

    from subpulse.sources.footers import stored_metadata
    days = [datetime(2024, 1, d) for d in (3, 9, 5)]
    for name, table, statistics in (
            ("whole/a", {"t": days}, True), ("whole/b", {"t": pa.array([None, None], pa.timestamp("us"))}, True),
            ("blind/a", {"t": days}, True), ("blind/b", {"t": days}, False), ("other/a", {"x": [1]}, True)):
        path = tmp_path / f"{name}.parquet"
        path.parent.mkdir(exist_ok=True)
        pq.write_table(pa.table(table), path, write_statistics=statistics, row_group_size=2)
    found = stored_metadata(spark, {n: (f"file://{tmp_path}/{n}", "t") for n in ("whole", "blind", "other")})
    assert {tuple(r) for r in found.collect()} == {
        ("whole", 5, datetime(2024, 1, 9), True), ("blind", 6, None, False), ("other", 1, None, False)}
    assert "ReadSchema: struct<path:string>" in found._jdf.queryExecution().executedPlan().toString()  # no content
