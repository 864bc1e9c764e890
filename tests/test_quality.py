import pytest
from pyspark.sql import functions as F

from subpulse import rules
from subpulse.operators import checks, quality
from subpulse.queries import AS_OF
from subpulse.sources import Tables


def one(df):
    row = df.first()
    return round(row.score, 6), row.label, row.issues


# dimension scores of a published run and the composites they gave
@pytest.mark.parametrize("scores, composite", [
    ((1.0, 5000 / 5050, 5000 / 5050, 1.0, 1.0), 99.65),
    ((1.0, 1.0, 1 - 82 / 14231, 1 - 284 / 14231, 1.0), 99.51),
    ((1.0, 1.0, 1 - 611 / 111129, 1.0, 1.0), 99.92),
    ((1.0, 1.0, 1 - 268 / 49863, 1.0, 1.0), 99.92),
    ((1.0, 1.0, 1 - 332 / 63527, 1.0, 1.0), 99.92)])
def test_composites(spark, scores, composite):
    df = spark.createDataFrame([scores], ", ".join(f"{d} double" for d in quality.DIMENSIONS))
    row = quality.composite_score(df).first()
    assert round(row.composite * 100, 2) == composite and row.status == "PASS"


def test_a_missing_dimension_counts_zero(spark):
    df = spark.createDataFrame([(1.0, 1.0)], "completeness double, uniqueness double")
    row = quality.composite_score(df).first()
    assert (row.composite, row.status) == (0.5, "FAIL")


@pytest.fixture
def sample(spark):
    return spark.createDataFrame(
        [(1, "x", "2024-01-01T00:00:00"), (1, None, "2024-02-01 00:00:00"), (2, "y", "nonsense"), (None, "zz", None)],
        "id int, kind string, at string")


def test_completeness(sample):
    assert one(quality.completeness(sample, ["id", "kind"])) == (
        0.75, "FAIL", ["Column 'id': 1 of 4 values are missing.", "Column 'kind': 1 of 4 values are missing."])
    score, _, issues = one(quality.completeness(sample, ["id", "gone"]))
    assert score == 0.375 and issues[1] == "Column 'gone' is absent."


def test_uniqueness(sample):
    assert one(quality.uniqueness(sample, "id")) == (0.5, "FAIL", ["Key 'id': 2 rows repeat a value or have none."])
    assert one(quality.uniqueness(sample, "gone"))[0] == 0.0
    assert one(quality.uniqueness(sample.limit(0), "id")) == (1.0, "PASS", [])


def test_timeliness_parses_every_format(sample):
    assert one(quality.timeliness(sample, "at", "2024-01-15 00:00:00")) == (
        0.25, "FAIL", ["1 timestamps lie in the future.", "2 timestamps cannot be read."])
    assert one(quality.timeliness(sample, "gone", AS_OF)) == (1.0, "PASS", [])


def test_referential(spark, sample):
    known = spark.createDataFrame([("x",), ("x",), (None,)], "k string")
    assert one(quality.referential(sample, "kind", known, "k")) == (
        0.25, "FAIL", ["2 rows refer to an unknown 'kind'.", "1 rows have no 'kind'."])
    assert one(quality.referential(sample, "gone", known, "k"))[0] == 1.0
    assert one(quality.referential(sample.limit(0), "kind", known, "k")) == (1.0, "PASS", [])


def test_validity_keeps_nulls_and_names_the_worst(spark):
    values = ["ok"] * 5 + [None] + ["a"] * 3 + ["b"] * 2 + ["c", "d", "e", "f"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    score, label, issues = one(quality.validity(df, "v", ["ok"]))
    assert score == round(1 - 9 / 15, 6) and label == "FAIL"
    assert issues == [
        "Column 'v': 9 values are not allowed, most often {'a': 3, 'b': 2, 'c': 1, 'd': 1, 'e': 1}."]
    assert one(quality.validity(df.filter("v = 'ok'"), "v", ["ok"])) == (1.0, "PASS", [])


def test_report_agrees_with_the_single_checks(tables):
    report = {r.dataset_name: r for r in quality.quality_report(tables, AS_OF).collect()}
    assert set(report) == set(rules.DQ_PROFILES)
    for name, p in rules.DQ_PROFILES.items():
        df = tables.dataset(name)
        singles = [quality.completeness(df, p["key_cols"]), quality.uniqueness(df, p["pk"]),
                   quality.timeliness(df, p["ts"], AS_OF), quality.validity(df, p["valid_col"], p["allowed"])]
        if p["fk"]:
            singles.append(quality.referential(df, p["fk"], tables.subscribers, "subscriber_id"))
        for check in singles:
            row = check.first()
            assert report[name][f"{row.dimension}_issues"] == row.issues, (name, row.dimension)
            assert report[name][f"{row.dimension}_score"] == pytest.approx(row.score * 100, abs=0.0051)
            assert report[name][f"{row.dimension}_label"] == row.label


def test_report_over_absent_columns_and_an_empty_table(tables):
    cooking = tables.product("cooking").filter("false")
    broken = Tables.of(tables.subscribers, {
        "news": tables.product("news").drop("event_type"), "games": tables.product("games"),
        "cooking": cooking, "athletic": tables.product("athletic").drop("event_id", "subscriber_id")})
    report = {r.dataset_name: r for r in quality.quality_report(broken, AS_OF).collect()}
    assert report["events_news"].validity_score == 0.0
    assert report["events_news"].validity_issues == ["Column 'event_type' is absent."]
    assert report["events_news"].completeness_score == 66.67
    assert report["events_athletic"].uniqueness_issues == ["Column 'event_id' is absent."]
    assert report["events_athletic"].referential_score == 100.0
    assert (report["events_cooking"].total_records, report["events_cooking"].uniqueness_score) == (0, 100.0)


def test_allowed_values_and_columns_may_hold_quotes(tables):
    odd = "player's choice"
    games = tables.product("games").withColumn("game_name", F.when(F.col("event_id") % 3 == 0, odd).otherwise(
        F.col("game_name")))
    apart = Tables.of(tables.subscribers, {p: games if p == "games" else tables.product(p) for p in tables.columns})
    games_profile = rules.DQ_PROFILES["events_games"]
    allowed = {**rules.DQ_PROFILES, "events_games": {**games_profile, "allowed": [*games_profile["allowed"], odd]}}
    scores = {r.dataset_name: r for r in quality.quality_report(apart, AS_OF, allowed).collect()}
    assert scores["events_games"].validity_score == 100.0
    issues = {r.dataset_name: r.validity_issues for r in quality.quality_report(apart, AS_OF).collect()}
    assert odd in issues["events_games"][0]


def test_the_report_scans_events_twice(tables):
    report = quality.quality_report(tables, AS_OF)
    report.collect()
    text = report._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    assert text.count("FileScan parquet [event_id") == 2 and "Python" not in text


def test_gate(tables):
    report = quality.quality_report(tables, AS_OF)
    assert quality.quality_gate(report) == []
    with pytest.raises(quality.QualityGateError, match="events_games"):
        quality.quality_gate(report.withColumn(
            "status", F.when(F.col("dataset_name") == "events_games", "FAIL").otherwise(F.col("status"))))
    warned = report.withColumn("status", F.when(F.col("dataset_name") == "subscribers", "WARN").otherwise("PASS"))
    assert quality.quality_gate(warned) == ["subscribers"]


def test_column_checks(spark):
    df = spark.createDataFrame([(1, "a", 0.0), (1, "b", 1800.0), (2, None, 1800.1), (None, "c", None)],
                               "id int, kind string, sec double")
    assert checks.not_null_failures(df, "kind").count() == 1
    assert [tuple(r) for r in checks.unique_failures(df, "id").collect()] == [(1, 2)]
    assert [tuple(r) for r in checks.accepted_values_failures(df, "kind", ["a", "b"]).collect()] == [("c", 1)]
    assert [r.sec for r in checks.accepted_range_failures(df, "sec", 0, 1800).collect()] == [1800.1]
    assert len(rules.COLUMN_TESTS) == 27
