"""Every registered query: (spark, sf_dir) -> DataFrame over the whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subpulse import rules
from subpulse.functions import expressions as X
from subpulse.operators import checks, drift, late, quality, relational
from subpulse.operators.quantiles import exact_percentiles
from subpulse.plans import activity_state, bundles, dashboard, health, maintenance, reports, scorecard, staging
from subpulse.plans import daily_active as metric
from subpulse.session import scratch_path
from subpulse.sinks import writers
from subpulse.sources import Tables, footers, from_driver_tables, read_csv, read_parquet
from subpulse.sources.readers import landing_registry, registered_schema, unparsed_cells

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2024-01-24 00:00:00"
FIRST_LOAD = "2024-01-20 00:00:00"
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


def on_tables(name: str, fn: Callable[[Tables], DataFrame]) -> None:
    """Register a query over the five raw tables."""
    QUERIES[name] = lambda spark, sf: fn(from_driver_tables(spark, sf))


def on_files(name: str, fn: Callable[[Tables], DataFrame]) -> None:
    """The same, with the types that the files have."""
    QUERIES[name] = lambda spark, sf: fn(from_driver_tables(spark, sf, own_types=True))


def native(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf}/{name}.parquet")


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    """Averages rounded, so the order of additions does not show."""
    return df.withColumns({c: F.round(c, digits) for c in cols})


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# --- sources and sinks -------------------------------------------------------

@query
def q_csv_scan(spark, sf):
    """Written with its columns in another order and one more, read back by name."""
    path, subscribers = scratch_path(spark, "subscribers-csv"), from_driver_tables(spark, sf).subscribers
    (subscribers.select(*reversed(subscribers.columns)).withColumn("unannounced", F.lit(1))
     .write.option("header", True).csv(path))
    return read_csv(spark, path, registered_schema("subscribers"))


@query
def q_csv_unparsed(spark, sf):
    """Orders as CSV with cells that do not parse, in two folders; each bad text with its folder, column and rows."""
    orders, path = native(spark, sf, "orders"), scratch_path(spark, "orders-csv")
    key = F.col("o_orderkey")
    orders.select(
        (key % 2).alias("half"), "o_orderkey",
        F.when(key % 97 == 0, "n/a").when(key % 89 == 0, "1,250.00").otherwise(F.col("o_totalprice").cast("string"))
        .alias("o_totalprice"),
        F.when(key % 83 == 0, F.concat(F.lit("day "), key % 5)).otherwise(F.col("o_orderdate").cast("date").cast("string"))
        .alias("o_orderdate")).write.partitionBy("half").option("header", True).csv(path)
    bad = unparsed_cells(spark, path, "o_orderkey bigint, o_totalprice double, o_orderdate date")
    return bad.withColumn("folder", F.regexp_extract("file", "(half=[0-9])", 1)).groupBy("folder", "column_name", "cell").agg(
        F.sum("n_rows").alias("n_rows"))


@query
def q_parquet_scan(spark, sf):
    return native(spark, sf, "orders").filter("o_orderstatus = 'F'").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.lit("orders").alias("source"))


@query
def q_source_registry(spark, sf):
    names = from_driver_tables(spark, sf).create_views("raw_")
    return union([spark.table(n).agg(F.lit(n).alias("source"), F.count(F.lit(1)).alias("row_count")) for n in names])


@query
def q_source_variants(spark, sf):
    """Clean and dirty files side by side; a table without a dirty file is read from its only one."""
    tables, registry = from_driver_tables(spark, sf), landing_registry(scratch_path(spark, "landing"))
    on_time = F.col("event_timestamp") <= X.as_of_ts(AS_OF)
    clean = {
        "subscribers": relational.first_per_key(tables.subscribers, ["subscriber_id"], ["created_at"]),
        "events_news": tables.product("news").filter("subscriber_id IS NOT NULL"),
        "events_games": tables.product("games").filter(on_time),
        "events_cooking": tables.product("cooking"),
        "events_athletic": tables.product("athletic"),
    }
    for name, df in clean.items():
        for variant, rows in (("clean", df), ("dirty", tables.dataset(name))):
            if variant == "clean" or name in registry.dirty:
                writer = rows.write.option("header", True)
                getattr(writer, registry.files[name][1])(registry.path(name, variant))
    return union([
        registry.read(spark, name, variant).agg(F.lit(name).alias("dataset"), F.lit(variant).alias("variant"),
                                                F.count(F.lit(1)).alias("row_count"))
        for name in clean for variant in ("clean", "dirty")])


@query
def q_full_refresh_load(spark, sf):
    tables = from_driver_tables(spark, sf)
    absent = landing_registry(scratch_path(spark, "nowhere")).read_if_present(spark, "events_news")
    sources = {f"raw_{n}": tables.dataset(n) for n in rules.REGISTRY} | {"raw_absent": absent}
    return writers.full_refresh(spark, sources, scratch_path(spark, "load"))


@query
def q_table_materialization(spark, sf):
    tables = from_driver_tables(spark, sf)
    name = writers.create_or_replace_table(
        dashboard.plan_distribution(tables.subscribers), "subpulse_marts", "plan_distribution",
        scratch_path(spark, "warehouse"))
    return spark.table(name)


@query
def q_view_materialization(spark, sf):
    name = writers.create_view(staging.stage_subscribers(from_driver_tables(spark, sf).subscribers, AS_OF),
                               "stg_subscribers_view")
    return spark.sql(f"SELECT bundle_tier, country, count(*) AS subscribers FROM {name} GROUP BY bundle_tier, country")


def _arrived_before(tables: Tables, moment: str) -> Tables:
    return Tables(tables.subscribers, tables.events.filter(F.col("arrival_ts") < X.as_of_ts(moment)), tables.columns)


@query
def q_daily_active_incremental(spark, sf):
    """First load with what had arrived by then, one increment, and the increment once more."""
    tables, path = from_driver_tables(spark, sf), scratch_path(spark, "metric")
    maintenance.build_metric(_arrived_before(tables, FIRST_LOAD), path, FIRST_LOAD)
    newest = maintenance.update_metric(spark, _arrived_before(tables, AS_OF), path, AS_OF)
    assert newest is not None
    maintenance.update_metric(spark, _arrived_before(tables, AS_OF), path, AS_OF)
    return maintenance.read_metric(spark, path)


@query
def q_reprocess_partitions(spark, sf):
    """A metric built without the late events, then repaired by the manifest."""
    tables, path = from_driver_tables(spark, sf), scratch_path(spark, "metric")
    late_after = late.LateLimits().of(F.concat(F.lit("events_"), "product"))
    on_time = X.us_to_hours(X.lag_us(F.col("event_timestamp"), F.col("arrival_ts"))) <= late_after
    maintenance.build_metric(Tables(tables.subscribers, tables.events.filter(on_time), tables.columns), path,
                             FIRST_LOAD)
    maintenance.repair_metric(tables, path, AS_OF)
    return maintenance.read_metric(spark, path)


def _state(spark: SparkSession, sf: str) -> DataFrame:
    """The stored bitmaps after a first load and after what arrived since, which also belongs to older dates."""
    tables, path = from_driver_tables(spark, sf), scratch_path(spark, "activity")
    early = F.coalesce(F.col("arrival_ts") < X.as_of_ts(FIRST_LOAD), F.lit(False))
    for arrived in (early, ~early):
        activity_state.add_activity(spark, Tables(tables.subscribers, tables.events.filter(arrived), tables.columns), path,
                                    AS_OF)
    return activity_state.read_state(spark, path)


@query
def q_daily_active_from_state(spark, sf):
    return activity_state.daily_active_of(_state(spark, sf), AS_OF)


@query
def q_weekly_active_from_state(spark, sf):
    return activity_state.weekly_active_of(_state(spark, sf))


@query
def q_daily_readers_from_state(spark, sf):
    return activity_state.daily_readers_of(_state(spark, sf))


@query
def q_active_between(spark, sf):
    """Distinct subscribers of news or games over two weeks, from stored bitmaps."""
    return activity_state.active_between(_state(spark, sf), "2024-01-05", "2024-01-18", ("news", "games"))


def _read_back(spark: SparkSession, name: str, parts: dict[str, DataFrame]) -> DataFrame:
    """A report written as JSON lines, read back and parsed: every row's name=value pairs in text order, joined by '|'."""
    path = scratch_path(spark, name)
    writers.write_json_report(reports.report_lines(parts), path)
    lines = spark.read.schema("section string, body string").json(path)
    return union([
        df.select(F.lit(section).alias("section"), F.array_join(F.array_sort(F.array_compact(F.array(
            *[F.concat(F.lit(f"{c}="), _as_text(df, c)) for c in df.columns]))), "|").alias("line"))
        for section, df in reports.read_lines(lines, parts).items()])


def _as_text(df: DataFrame, col: str):
    if df.schema[col].dataType.typeName() == "array":
        return F.array_join(col, " ")
    return F.col(col).cast("string")


@query
def q_json_report(spark, sf):
    return _read_back(spark, "dq-report", reports.quality_parts(from_driver_tables(spark, sf), AS_OF))


@query
def q_late_report(spark, sf):
    return _read_back(spark, "late-report", reports.late_parts(from_driver_tables(spark, sf)))


@query
def q_dashboard_report(spark, sf):
    return _read_back(spark, "dashboard", reports.dashboard_parts(from_driver_tables(spark, sf), AS_OF))


@query
def q_drift_report(spark, sf):
    return _read_back(spark, "drift-report", reports.drift_parts(drifted(from_driver_tables(spark, sf, own_types=True))))


@query
def q_stg_news_by_date(spark, sf):
    """Staged news as a table partitioned by date."""
    path = scratch_path(spark, "stg-news")
    staged = staging.stage_events(from_driver_tables(spark, sf).product("news"), AS_OF)
    writers.write_by_date(staged, path, ("event_type",))
    return spark.read.parquet(path)


@query
def q_asset_metadata(spark, sf):
    tables = from_driver_tables(spark, sf)
    return writers.asset_metadata({
        "raw_subscribers": (tables.subscribers, "created_at"),
        **{f"raw_events_{p}": (tables.product(p), "event_timestamp") for p in rules.PRODUCTS},
        "orders": (native(spark, sf, "orders"), "o_orderdate"),
        "region": (native(spark, sf, "region"), None),
    })


@query
def q_stored_metadata(spark, sf):
    """Rows and newest value of stored tables from their footers; a staged table is one of many files."""
    staged = scratch_path(spark, "staged")
    news = staging.stage_events(from_driver_tables(spark, sf).product("news"), AS_OF)
    writers.write_by_date(news.select("event_id", "event_timestamp_clean", "event_date"), staged)
    return footers.stored_metadata(spark, {
        "orders": (f"{sf}/orders.parquet", "o_orderdate"), "events": (f"{sf}/events.parquet", "ts"),
        "region": (f"{sf}/region.parquet", None), "stg_events_news": (staged, "event_timestamp_clean")})


# --- staging -----------------------------------------------------------------

on_tables("stg_subscribers", lambda t: staging.stage_subscribers(t.subscribers, AS_OF))
for _p in rules.PRODUCTS:
    on_tables(f"stg_events_{_p}", lambda t, p=_p: staging.stage_events(t.product(p), AS_OF))
on_tables("quarantine_events", lambda t: union([
    staging.quarantine_events(t.product(p), AS_OF).select(
        F.lit(p).alias("product"), "event_id", "event_type", "event_timestamp", "event_timestamp_clean", "event_date",
        "platform", "has_future_timestamp") for p in rules.PRODUCTS]))


@query
def q_first_order_per_customer(spark, sf):
    return relational.first_per_key(native(spark, sf, "orders"), ["o_custkey"], ["o_orderdate"])


# --- daily active ------------------------------------------------------------

on_tables("qualifying_activity", lambda t: metric.qualifying_activity(t.events, AS_OF))
on_tables("enriched_activity", lambda t: metric.enriched_activity(
    metric.qualifying_activity(t.events, AS_OF), staging.stage_subscribers(t.subscribers, AS_OF)))
on_tables("daily_active", lambda t: metric.daily_active(t, AS_OF))
on_tables("daily_active_14_days", lambda t: metric.daily_active(t, AS_OF, 14))
on_tables("daily_active_grouping_sets", lambda t: metric.daily_active_grouping_sets(t, AS_OF))
on_tables("daily_active_latest_first",
          lambda t: metric.daily_active(t, AS_OF).orderBy(F.desc("event_date"), "product"))

# --- health ------------------------------------------------------------------

for _p in rules.PRODUCTS:
    on_tables(f"engagement_{_p}", lambda t, p=_p: (
        rounded(health.engagement(t.product(p), p, AS_OF),
                *(["news_completion_rate", "news_avg_dwell_sec"] if p == "news" else []))))
on_tables("subscriber_health", lambda t: rounded(
    health.subscriber_health(t, AS_OF), "news_completion_rate", "news_avg_dwell_sec"))
on_tables("subscriber_health_14_days", lambda t: rounded(
    health.subscriber_health(t, AS_OF, 14), "news_completion_rate", "news_avg_dwell_sec"))
on_tables("churn_risk_summary", lambda t: health.churn_risk_summary(health.subscriber_health(t, AS_OF)))
on_tables("health_snapshots", lambda t: union([
    health.health_snapshot(t, day).groupBy("snapshot_date", "churn_risk_tier").agg(
        F.count(F.lit(1)).alias("subscribers"), F.sum("products_engaged_count").alias("products_engaged"))
    for day in (FIRST_LOAD, AS_OF)]))
on_tables("engagement_velocity", lambda t: health.engagement_velocity(t.events, AS_OF))

# --- quality -----------------------------------------------------------------


def _scored(name: str, check: DataFrame) -> DataFrame:
    return check.select(F.lit(name).alias("dataset"), "dimension", F.round("score", 6).alias("score"), "label",
                        F.array_join("issues", " ").alias("issues"))


@query
def q_dq_completeness(spark, sf):
    t = from_driver_tables(spark, sf)
    return union([
        _scored("subscribers", quality.completeness(t.subscribers, rules.DQ_PROFILES["subscribers"]["key_cols"])),
        _scored("events_news", quality.completeness(t.product("news"), ["event_id", "subscriber_id", "gone"])),
        _scored("orders", quality.completeness(native(spark, sf, "orders"), ["o_orderkey", "o_orderdate"])),
    ])


@query
def q_dq_uniqueness(spark, sf):
    t = from_driver_tables(spark, sf)
    return union([
        _scored("subscribers", quality.uniqueness(t.subscribers, "subscriber_id")),
        _scored("events_news", quality.uniqueness(t.product("news"), "subscriber_id")),
        _scored("lineitem", quality.uniqueness(native(spark, sf, "lineitem"), "l_orderkey")),
    ])


@query
def q_dq_timeliness(spark, sf):
    t = from_driver_tables(spark, sf)
    return union([
        _scored("subscribers", quality.timeliness(t.subscribers, "created_at", AS_OF)),
        _scored("events_games", quality.timeliness(t.product("games"), "event_timestamp", AS_OF)),
        _scored("orders", quality.timeliness(native(spark, sf, "orders"), "o_orderdate", "1998-01-01 00:00:00")),
    ])


@query
def q_dq_referential(spark, sf):
    t = from_driver_tables(spark, sf)
    customer = native(spark, sf, "customer")
    return union([
        _scored("events_news", quality.referential(t.product("news"), "subscriber_id", t.subscribers, "subscriber_id")),
        _scored("orders", quality.referential(native(spark, sf, "orders"), "o_custkey", customer, "c_custkey")),
        _scored("customer", quality.referential(customer, "c_custkey", native(spark, sf, "events"), "user_id")),
    ])


@query
def q_dq_validity(spark, sf):
    t = from_driver_tables(spark, sf)
    return union([
        _scored("subscribers_6", quality.validity(t.subscribers, "plan_type", rules.REGISTERED_PLANS)),
        _scored("subscribers_7", quality.validity(t.subscribers, "plan_type", rules.KNOWN_PLANS)),
        _scored("orders", quality.validity(native(spark, sf, "orders"), "o_orderstatus", ["F", "O"])),
    ])


@query
def q_dq_composite(spark, sf):
    """Composite of a table outside the five profiles, from single checks."""
    orders, customer = native(spark, sf, "orders"), native(spark, sf, "customer")
    checks_run = union([
        quality.completeness(orders, ["o_orderkey", "o_custkey"]),
        quality.uniqueness(orders, "o_custkey"),
        quality.timeliness(orders, "o_orderdate", "1998-01-01 00:00:00"),
        quality.referential(orders, "o_custkey", customer, "c_custkey"),
        quality.validity(orders, "o_orderstatus", ["F", "O"]),
    ])
    wide = checks_run.agg(*[
        F.max(F.when(F.col("dimension") == d, F.col("score"))).alias(d) for d in quality.DIMENSIONS])
    return quality.composite_score(wide).select(F.lit("orders").alias("dataset"), "composite", "status")


def _report_numbers(report: DataFrame) -> DataFrame:
    return report.select(
        "dataset_name", "domain", "run_at", "total_records", "composite_score", "status",
        *[F.col(f"{d}_{c}") for d in quality.DIMENSIONS for c in ("score", "label")],
        *[F.array_join(f"{d}_issues", " ").alias(f"{d}_issues") for d in quality.DIMENSIONS])


on_tables("dq_report", lambda t: _report_numbers(quality.quality_report(t, AS_OF)))
on_tables("dq_dimensions", lambda t: quality.quality_dimensions(quality.quality_report(t, AS_OF)).select(
    "dataset_name", "dimension", "score", "label"))
on_tables("dq_summary", lambda t: quality.quality_summary(quality.quality_report(t, AS_OF)))
on_tables("dq_gates", lambda t: quality.quality_gates(quality.quality_report(t, AS_OF)))
on_tables("dq_scorecard", lambda t: rounded(
    scorecard.worst_first(scorecard.quality_scorecard(t, AS_OF)), *scorecard.RATIOS))


@query
def q_column_tests(spark, sf):
    t = from_driver_tables(spark, sf)
    relations = {"raw.subscribers": t.subscribers,
                 **{f"raw.events_{p}": (t.events, "product", p) for p in rules.PRODUCTS}}
    relations["stg.subscribers"] = staging.stage_subscribers(t.subscribers, AS_OF)
    relations["stg.events_news"] = staging.stage_events(t.product("news"), AS_OF)
    return checks.run_column_tests(relations, rules.COLUMN_TESTS)


on_tables("test_not_null", lambda t: checks.not_null_failures(t.subscribers, "plan_type").select(
    "subscriber_id", "created_at"))
on_tables("test_unique", lambda t: checks.unique_failures(t.subscribers, "subscriber_id"))
QUERIES["test_unique_orders"] = lambda s, sf: checks.unique_failures(native(s, sf, "orders"), "o_custkey")
on_tables("test_accepted_values", lambda t: checks.accepted_values_failures(
    t.subscribers, "plan_type", rules.KNOWN_PLANS))
QUERIES["test_accepted_values_orders"] = lambda s, sf: checks.accepted_values_failures(
    native(s, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])
on_tables("test_accepted_range", lambda t: checks.accepted_range_failures(
    t.product("news"), "time_on_page_sec", 0, 1800).select("event_id", F.round("time_on_page_sec", 6).alias("dwell")))
on_tables("top_invalid_values", lambda t: relational.most_frequent(
    t.subscribers.filter(~F.col("plan_type").isin(rules.REGISTERED_PLANS)), "plan_type", rules.TOP_INVALID))

# --- drift -------------------------------------------------------------------


def drifted(t: Tables) -> dict[str, DataFrame]:
    """The raw tables after a rename, a narrowed type and an unannounced column.

    The names are fixed values: a published report of this scenario has them.
    """
    return {
        "subscribers": t.subscribers,
        "events_games": t.product("games").withColumnRenamed("game_name", "game_title"),
        "events_athletic": t.product("athletic").withColumn("time_on_page_sec", F.col("time_on_page_sec").cast("bigint")),
        "events_news": t.product("news").withColumn("scroll_depth_pct", F.lit(50.0)),
        "events_cooking": t.product("cooking"),
    }


on_files("drift_events", lambda t: drift.detect_drift(drifted(t)))
# fixed values: what a reader of three of the given files might expect of them
FILE_REGISTRY = {
    "orders": [("o_orderkey", "bigint", False, True), ("o_custkey", "int", False, True),
               ("o_orderstatus", "string", True, False), ("o_totalprice", "decimal(15,2)", True, True),
               ("o_orderdate", "timestamp_ntz", True, True), ("o_clerk", "string", True, False)],
    "customer": [("c_custkey", "bigint", False, True), ("c_name", "string", True, False),
                 ("c_segment", "string", True, True)],
    "events": [("event_id", "bigint", False, True), ("ts", "timestamp_ntz", False, True),
               ("user_id", "bigint", False, True), ("event_type", "string", True, False),
               ("value", "double", True, False), ("props", "string", True, False)],
}


FILE_TABLES = ("customer", "events", "lineitem", "nation", "orders", "part", "region", "supplier")


@query
def q_drift_columns(spark, sf):
    """The files' own schemas against expectations, with how many rows have a value in each drifted column."""
    files = {name: native(spark, sf, name) for name in FILE_REGISTRY}
    found = drift.column_drift(spark, {name: df.schema for name, df in files.items()}, FILE_REGISTRY)
    filled = union([drift.column_presence(df.withColumn("dataset", F.lit(name)), ["dataset"]) for name, df in files.items()])
    return found.join(filled.select("dataset", "column_name", "n_rows", "n_filled"), ["dataset", "column_name"], "left")


@query
def q_drift_files(spark, sf):
    """Every file's own schema, from its footer, against expectations."""
    found = [drift.file_drift(drift.file_schemas(spark, f"{sf}/{name}.parquet"), columns).withColumn("dataset", F.lit(name))
             for name, columns in FILE_REGISTRY.items()]
    return union(found).withColumn("file", F.regexp_extract("file", "[^/]+$", 0))


@query
def q_file_schemas(spark, sf):
    """Columns and types of the generic tables' files, as their footers have them."""
    schemas = drift.file_schemas(spark, *[f"{sf}/{name}.parquet" for name in FILE_TABLES])
    return schemas.select(F.regexp_extract("file", "[^/]+$", 0).alias("file"), "column_name", "dtype")


on_files("drift_enum", lambda t: drift.enum_violations({n: t.dataset(n) for n in rules.REGISTRY}))
on_files("drift_status", lambda t: drift.drift_status(drift.detect_drift(drifted(t)), list(rules.REGISTRY)))
on_files("drift_summary", lambda t: drift.drift_summary(
    drift.drift_status(drift.detect_drift(drifted(t)), list(rules.REGISTRY))))


on_files("drift_gates", lambda t: drift.drift_gates(
    drift.drift_status(drift.detect_drift(drifted(t)), list(rules.REGISTRY))))
on_files("drift_partitions", lambda t: drift.column_presence(
    t.events.withColumn("event_date", F.to_date("event_timestamp")), ["product", "event_date"],
    ["subscriber_id", "section", "time_on_page_sec", "game_name", "score", "rating", "sport"]))


@query
def q_drift_latest_day(spark, sf):
    """The enumeration check on the newest date of the games events, against a shorter list of games."""
    games = from_driver_tables(spark, sf).product("games").withColumn("event_date", F.to_date("event_timestamp"))
    enums = {"events_games": ("game_name", ["wordle", "crossword", "strands"], "WARNING")}
    return drift.enum_violations({"events_games": drift.latest_days(games, "event_date")}, enums, by=["event_date"])


# --- late arrivals -----------------------------------------------------------


def on_lag(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    on_tables(name, lambda t: fn(late.with_lag(t.events)))


on_lag("late_events", lambda lag: rounded(
    lag.select("event_id", "domain", "event_date", "lag_hours", "is_late", "lag_bucket"), "lag_hours"))
on_lag("late_shares", late.late_shares)
on_lag("late_domain_stats", late.late_domain_stats)
on_lag("late_platform", late.late_platforms)
on_lag("late_days", late.late_days)
on_lag("late_buckets", late.late_buckets)
on_lag("late_manifest", late.reprocessing_manifest)
on_lag("late_summary", late.late_summary)
HALF_A_DAY = late.LateLimits.after(12)
on_tables("late_manifest_12_hours", lambda t: late.reprocessing_manifest(late.with_lag(t.events, HALF_A_DAY), HALF_A_DAY))
on_tables("late_summary_12_hours", lambda t: late.late_summary(late.with_lag(t.events, HALF_A_DAY), HALF_A_DAY))

# --- dashboard ---------------------------------------------------------------

on_tables("plan_distribution", lambda t: dashboard.plan_distribution(t.subscribers))
on_tables("acquisition_distribution", lambda t: dashboard.acquisition_distribution(t.subscribers))
on_tables("tier_distribution", lambda t: dashboard.tier_distribution(t.subscribers))
on_tables("churn_by_plan", lambda t: dashboard.churn_by_plan(t.subscribers))
on_tables("weekly_active", lambda t: dashboard.weekly_active(t.events))
on_tables("game_completions", lambda t: dashboard.game_completions(t.product("games")))
on_tables("daily_readers", lambda t: dashboard.daily_readers(t.product("news")))
on_tables("multi_product", lambda t: dashboard.multi_product(t.events))
on_tables("product_breadth", lambda t: dashboard.product_breadth(t.events))
on_tables("risk_buckets", lambda t: dashboard.risk_buckets(t.subscribers, AS_OF))
on_tables("section_readers", lambda t: dashboard.section_readers(t.product("news")))
on_tables("kpis", lambda t: dashboard.kpis(t, AS_OF))

# --- finance metrics named next to the daily metric --------------------------

on_tables("bundle_metrics", lambda t: bundles.bundle_metrics(
    t.events, staging.stage_subscribers(t.subscribers, AS_OF), AS_OF))
on_tables("churn_rate", lambda t: bundles.churn_rate(staging.stage_subscribers(t.subscribers, AS_OF), AS_OF))
on_tables("bundle_ltv", lambda t: bundles.bundle_ltv(staging.stage_subscribers(t.subscribers, AS_OF)))

# --- generic operators on other tables ---------------------------------------


@query
def q_membership_by_event_type(spark, sf):
    return relational.membership_counts(native(spark, sf, "events"), "user_id", native(spark, sf, "orders"),
                                        "o_custkey", by=["event_type"])


@query
def q_customers_with_orders(spark, sf):
    return relational.rows_with_key(native(spark, sf, "customer"), "c_custkey", native(spark, sf, "orders"),
                                    "o_custkey").select("c_custkey", "c_mktsegment")


@query
def q_customers_without_events(spark, sf):
    return relational.rows_without_key(native(spark, sf, "customer"), "c_custkey", native(spark, sf, "events"),
                                       "user_id").select("c_custkey", "c_mktsegment")


@query
def q_priority_counts(spark, sf):
    return relational.value_counts(native(spark, sf, "orders"), "o_orderpriority")


@query
def q_open_rate_by_priority(spark, sf):
    return relational.group_rate(native(spark, sf, "orders"), "o_orderpriority", F.col("o_orderstatus") == "O")


@query
def q_busiest_customers(spark, sf):
    return relational.most_frequent(native(spark, sf, "orders"), "o_custkey", 20)


@query
def q_trailing_month_orders(spark, sf):
    orders = native(spark, sf, "orders").withColumn("order_date", F.to_date("o_orderdate"))
    newest = orders.agg(F.max("order_date").alias("newest"))
    return relational.trailing_days(orders, "order_date", newest, 30).groupBy("order_date").agg(
        F.count(F.lit(1)).alias("orders"))


@query
def q_price_percentiles(spark, sf):
    """Interpolated percentiles of order prices in cents, per status."""
    cents = native(spark, sf, "orders").withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("bigint"))
    return rounded(exact_percentiles(cents, ["o_orderstatus"], "cents",
                                     {"p50": 0.5, "p95": 0.95, "p99": 0.99}), "p50", "p95", "p99", digits=3)
