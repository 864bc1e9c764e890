"""Five-dimension data quality: single checks, dataset reports and the gate.

Scores and issue texts are written once, as SQL text over counts: a single check
counts one table, the report counts all of them together. Text keeps the driver
quick, one string a column; names and values in it are quoted by ``X.quoted`` and
``X.literal``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subpulse import rules
from subpulse.functions import expressions as X
from subpulse.functions.local import constant_table
from subpulse.operators.relational import membership_counts
from subpulse.sources.tables import Tables

DIMENSIONS = list(rules.DQ_WEIGHTS)
SHARES = 32
ABSENT = "CAST(NULL AS STRING)"


class QualityGateError(RuntimeError):
    """Raised by :func:`quality_gate`."""


# --- scores out of counts ----------------------------------------------------

def _share_kept(bad: str, total: str = "total") -> str:
    """1 - bad / total, 1 for an empty table."""
    return f"IF({total} > 0, 1.0D - ({bad}) / {total}, 1.0D)"


def _distinct_share(keys: str = "keys", total: str = "total") -> str:
    return f"IF({total} > 0, {keys} / {total}, 1.0D)"


def _filled_share(nulls: str, total: str = "total") -> str:
    return f"1.0D - try_divide({nulls}, {total})"


def _label(score: str) -> str:
    return (f"CASE WHEN {score} >= {rules.PASS_AT}D THEN 'PASS' WHEN {score} >= {rules.WARN_AT}D THEN 'WARN' "
            "ELSE 'FAIL' END")


# --- issue texts out of counts; NULL when there is nothing to say -------------
# ``name`` is SQL text: a literal or a column that holds the name

def _absent(name: str) -> str:
    return f"""format_string("Column '%s' is absent.", {name})"""


def _missing(name: str, nulls: str, total: str = "total") -> str:
    return (f"IF(try_divide({nulls}, {total}) > {rules.NULL_SHARE_ISSUE}D, "
            f"""format_string("Column '%s': %d of %d values are missing.", {name}, {nulls}, {total}), NULL)""")


def _repeated(name: str, n: str = "total - keys") -> str:
    return f"""IF({n} > 0, format_string("Key '%s': %d rows repeat a value or have none.", {name}, {n}), NULL)"""


UNTIMELY = ["IF(future > 0, format_string('%d timestamps lie in the future.', future), NULL)",
            "IF(unparsed > 0, format_string('%d timestamps cannot be read.', unparsed), NULL)"]


def _unlinked(name: str) -> list[str]:
    return [f"""IF(orphans > 0, format_string("%d rows refer to an unknown '%s'.", orphans, {name}), NULL)""",
            f"""IF(nulls > 0, format_string("%d rows have no '%s'.", nulls, {name}), NULL)"""]


def _not_allowed(name: str) -> str:
    return ("IF(invalid > 0, format_string(\"Column '%s': %d values are not allowed, most often {%s}.\", "
            f"{name}, invalid, worst), NULL)")


# --- single checks: one row (dimension, score, label, issues) ----------------

def _check(counts: DataFrame, name: str, score: str, issues: Sequence[str] = ()) -> DataFrame:
    return counts.selectExpr(f"'{name}' AS dimension", f"CAST({score} AS DOUBLE) AS score",
                             f"{_label(score)} AS label", f"array_compact(array({', '.join(issues or [ABSENT])})) AS issues")


def _total(df: DataFrame, *counts: str) -> DataFrame:
    return df.agg(F.expr("count(1) AS total"), *map(F.expr, counts))


def completeness(df: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Mean non-null share of the key columns; an absent column counts 0."""
    if not key_cols:
        return _check(_total(df), "completeness", "0.0D")
    present = {c: f"null_{i}" for i, c in enumerate(key_cols) if c in df.columns}
    counts = _total(df, *[f"count_if({X.quoted(c)} IS NULL) AS {slot}" for c, slot in present.items()])
    shares = " + ".join(["0.0D", *map(_filled_share, present.values())])
    return _check(counts, "completeness", f"({shares}) / {len(key_cols)}", [
        _missing(X.literal(c), present[c]) if c in present else _absent(X.literal(c)) for c in key_cols])


def uniqueness(df: DataFrame, pk: str) -> DataFrame:
    """Distinct keys over rows; NULL is not a distinct key."""
    if pk not in df.columns:
        return _check(_total(df), "uniqueness", "0.0D", [_absent(X.literal(pk))])
    return _check(_total(df, f"count(DISTINCT {X.quoted(pk)}) AS keys"), "uniqueness", _distinct_share(),
                  [_repeated(X.literal(pk))])


def timeliness(df: DataFrame, ts_col: str, as_of: X.AsOf = None) -> DataFrame:
    """Share of rows whose time parses and is not in the future."""
    if ts_col not in df.columns:
        return _check(_total(df), "timeliness", "1.0D")
    ts = X.ts_sql(df, ts_col)
    counts = _total(df, f"count_if({ts} > {X.now_sql(as_of)}) AS future", f"count_if({ts} IS NULL) AS unparsed")
    return _check(counts, "timeliness", _share_kept("future + unparsed"), UNTIMELY)


def referential(df: DataFrame, fk: str, ref: DataFrame, ref_col: str) -> DataFrame:
    """Share of rows whose key is not NULL and exists in ``ref``."""
    if fk not in df.columns:
        return _check(_total(df), "referential", "1.0D")
    return _check(membership_counts(df, fk, ref, ref_col), "referential", _share_kept("orphans + nulls"),
                  _unlinked(X.literal(fk)))


def _outside(col: str, allowed: Sequence) -> str:
    return f"coalesce({X.quoted(col)} NOT IN ({', '.join(map(X.literal, allowed))}), false)"


def validity(df: DataFrame, col: str, allowed: Sequence) -> DataFrame:
    """Share of rows whose value is allowed; NULL counts as valid here."""
    if col not in df.columns:
        return _check(_total(df), "validity", "0.0D", [_absent(X.literal(col))])
    bad = _outside(col, allowed)
    per_value = df.selectExpr("'' AS dataset_name", f"IF({bad}, CAST({X.quoted(col)} AS STRING), NULL) AS value").groupBy(
        "dataset_name", "value").agg(F.expr("count(1) AS total"))
    counts = _with_worst(per_value, []).agg(F.expr("coalesce(max(total), 0L) AS total"),
                                            F.expr("coalesce(max(invalid), 0L) AS invalid"), F.expr("max(worst) AS worst"))
    return _check(counts, "validity", _share_kept("invalid"), [_not_allowed(X.literal(col))])


def _with_worst(per_value: DataFrame, sums: Sequence[str]) -> DataFrame:
    """(dataset_name, value, total, *sums) rolled up per dataset, with ``invalid`` rows and the ``worst`` values as text.

    The worst values are found in each of some shares of a dataset first, so no
    task sorts all of a column full of distinct garbage.
    """
    summed = [f"sum({c}) AS {c}" for c in ("total", *sums)]
    return per_value.selectExpr(
        "*", "pmod(xxhash64(value), {n}) AS share".format(n=SHARES)).selectExpr(
        "*", "row_number() OVER (PARTITION BY dataset_name, share ORDER BY value IS NULL, total DESC, value) AS rank"
    ).groupBy("dataset_name", "share").agg(
        *map(F.expr, summed), F.expr("sum(IF(value IS NOT NULL, total, 0L)) AS invalid"),
        F.expr(f"collect_list(IF(rank <= {rules.TOP_INVALID} AND value IS NOT NULL, struct(-total AS n, value), NULL)) AS top")
    ).groupBy("dataset_name").agg(
        *map(F.expr, summed), F.expr("sum(invalid) AS invalid"),
        F.expr(f"""array_join(transform(slice(array_sort(flatten(collect_list(top))), 1, {rules.TOP_INVALID}),
                   x -> format_string("'%s': %d", x.value, -x.n)), ', ') AS worst"""))


# --- dataset reports ---------------------------------------------------------

def _live(tables: Tables) -> dict[str, Sequence[str]]:
    return {"subscribers": tables.subscribers.columns, **{f"events_{p}": c for p, c in tables.columns.items()}}


def _checked(df: DataFrame, dataset: str, arms: dict[str, tuple[Sequence[str], dict]], as_of: X.AsOf,
             slots: int) -> DataFrame:
    """The rows of ``df``, reduced to what the checks read; ``arms`` are the (live columns, profile) of its datasets.

    Datasets that agree on a column share one expression; the others are told
    apart by the name that the expression ``dataset`` gives.
    """
    def by_dataset(make: Callable[[Sequence[str], dict], str]) -> str:
        made: dict[str, list[str]] = {}
        for name, (live, profile) in arms.items():
            made.setdefault(make(live, profile), []).append(name)
        out, *others = made
        for text in others:
            out = f"CASE WHEN {dataset} IN ({', '.join(map(X.literal, made[text]))}) THEN {text} ELSE {out} END"
        return out

    def null(slot: int) -> Callable[[Sequence[str], dict], str]:
        def make(live, profile):
            col = profile["key_cols"][slot] if slot < len(profile["key_cols"]) else None
            return f"{X.quoted(col)} IS NULL" if col in live else "false"
        return make

    def of(field: str, found: Callable[[dict], str], otherwise: str) -> str:
        return by_dataset(lambda live, profile: found(profile) if profile[field] in live else otherwise)

    now = X.now_sql(as_of)
    return df.selectExpr(
        f"{dataset} AS dataset_name",
        of("pk", lambda p: f"CAST({X.quoted(p['pk'])} AS STRING)", ABSENT) + " AS pk",
        of("fk", lambda p: f"CAST({X.quoted(p['fk'])} AS STRING)", ABSENT) + " AS fk",
        of("valid_col", lambda p: f"IF({_outside(p['valid_col'], p['allowed'])}, "
                                  f"CAST({X.quoted(p['valid_col'])} AS STRING), NULL)", ABSENT) + " AS value",
        of("ts", lambda p: f"coalesce({X.ts_sql(df, p['ts'])} > {now}, false)", "false") + " AS future",
        of("ts", lambda p: f"{X.ts_sql(df, p['ts'])} IS NULL", "false") + " AS unparsed",
        *[f"{by_dataset(null(i))} AS null_{i}" for i in range(slots)])


def _profile_table(tables: Tables, profiles: dict[str, dict]) -> DataFrame:
    """One constant row per profile: its columns, and which of them its table has."""
    live, slots = _live(tables), max(len(p["key_cols"]) for p in profiles.values())
    columns = {"dataset_name": "string", "domain": "string", "n_keys": "int", "pk": "string", "pk_live": "boolean",
               "fk": "string", "fk_live": "boolean", "valid_col": "string", "valid_live": "boolean",
               **{f"key_{i}": "string" for i in range(slots)}, **{f"absent_{i}": "boolean" for i in range(slots)}}
    rows = []
    for name, p in profiles.items():
        keys = [*p["key_cols"], *[None] * (slots - len(p["key_cols"]))]
        rows.append((name, p["domain"], len(p["key_cols"]), p["pk"], p["pk"] in live[name], p["fk"],
                     p["fk"] in live[name], p["valid_col"], p["valid_col"] in live[name], *keys,
                     *[k is not None and k not in live[name] for k in keys]))
    return constant_table(tables.events.sparkSession, columns, rows)


def quality_counts(tables: Tables, as_of: X.AsOf = None, profiles: dict[str, dict] | None = None) -> DataFrame:
    """One row per dataset with every count the scores derive from.

    Two passes: one aggregation by (dataset, foreign key, bad value) gives the
    plain counts, the orphans and the most frequent bad values once it is rolled
    up; the other one counts distinct primary keys.
    """
    profiles = profiles or rules.DQ_PROFILES
    slots = max(len(p["key_cols"]) for p in profiles.values())
    live = _live(tables)
    arms = {name: (live[name], p) for name, p in profiles.items()}
    subs = _checked(tables.subscribers, "'subscribers'", {"subscribers": arms["subscribers"]}, as_of, slots)
    events = _checked(tables.events, "concat('events_', product)",
                      {name: arm for name, arm in arms.items() if name != "subscribers"}, as_of, slots)
    rows = subs.union(events)
    flags = ["future", "unparsed", *[f"null_{i}" for i in range(slots)]]
    per_link = rows.groupBy("dataset_name", "fk", "value").agg(
        F.expr("count(1) AS total"), *[F.expr(f"count_if({c}) AS {c}") for c in flags])
    known = tables.subscribers.selectExpr("CAST(subscriber_id AS STRING) AS fk").distinct().selectExpr("fk", "true AS known")
    linked = ", ".join(X.literal(name) for name, p in profiles.items() if p["fk"] in live[name]) or "NULL"
    per_value = per_link.join(known, "fk", "left").groupBy("dataset_name", "value").agg(
        *[F.expr(f"sum({c}) AS {c}") for c in ("total", *flags)],
        F.expr(f"sum(IF(dataset_name IN ({linked}) AND fk IS NOT NULL AND known IS NULL, total, 0L)) AS orphans"),
        F.expr(f"sum(IF(dataset_name IN ({linked}) AND fk IS NULL, total, 0L)) AS nulls"))
    plain = _with_worst(per_value, [*flags, "orphans", "nulls"])
    keys = rows.groupBy("dataset_name").agg(F.expr("count(DISTINCT pk) AS keys"))
    # an empty dataset still gets its row
    listed = _profile_table(tables, profiles)
    counts = ["total", *flags, "orphans", "nulls", "invalid", "keys"]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                    [listed.selectExpr("dataset_name", "0L AS total"), plain, keys])
    return merged.groupBy("dataset_name").agg(
        *[F.expr(f"coalesce(max({c}), 0L) AS {c}") for c in counts], F.expr("max(worst) AS worst"),
    ).join(listed, "dataset_name")


def quality_report(tables: Tables, as_of: X.AsOf = None, profiles: dict[str, dict] | None = None) -> DataFrame:
    """One row per dataset: composite score, status, and (score, label, issues) per dimension.

    Scores are percentages with two decimals; labels follow the unrounded score,
    the status follows the composite rounded to four decimals.
    """
    counts = quality_counts(tables, as_of, profiles)
    slots = range(sum(c.startswith("absent_") for c in counts.columns))

    shares = [f"IF(n_keys <= {i} OR absent_{i}, 0.0D, {_filled_share(f'null_{i}')})" for i in slots]
    scores = {
        "completeness": f"({' + '.join(shares)}) / n_keys",
        "uniqueness": f"IF(pk_live, {_distinct_share()}, 0.0D)",
        "timeliness": _share_kept("future + unparsed"),
        "referential": f"IF(fk_live, {_share_kept('orphans + nulls')}, 1.0D)",
        "validity": f"IF(valid_live, {_share_kept('invalid')}, 0.0D)",
    }
    issues = {
        "completeness": [f"CASE WHEN n_keys <= {i} THEN NULL WHEN absent_{i} THEN {_absent(f'key_{i}')} "
                         f"ELSE {_missing(f'key_{i}', f'null_{i}')} END" for i in slots],
        "uniqueness": [f"IF(pk_live, {_repeated('pk')}, {_absent('pk')})"],
        "timeliness": UNTIMELY,
        "referential": _unlinked("fk"),
        "validity": [f"IF(valid_live, {_not_allowed('valid_col')}, {_absent('valid_col')})"],
    }
    composite = "round(" + " + ".join(f"_{d} * {w}D" for d, w in rules.DQ_WEIGHTS.items()) + ", 4)"
    return counts.selectExpr(
        "dataset_name", "domain", "total", *[f"CAST({text} AS DOUBLE) AS _{d}" for d, text in scores.items()],
        *[f"array_compact(array({', '.join(texts)})) AS {d}_issues" for d, texts in issues.items()],
    ).selectExpr("*", f"{composite} AS _composite").selectExpr(
        "dataset_name", "domain", f"{X.now_sql(as_of)} AS run_at", "total AS total_records",
        "round(_composite * 100, 2) AS composite_score", f"{_label('_composite')} AS status",
        *[text for d in DIMENSIONS for text in (
            f"round(_{d} * 100, 2) AS {d}_score", f"{_label('_' + d)} AS {d}_label", f"{d}_issues")])


def composite_score(scores: DataFrame) -> DataFrame:
    """Composite and status over 0-1 columns named after the dimensions; an absent one counts 0."""
    terms = [(F.coalesce(F.col(d), F.lit(0.0)), w) for d, w in rules.DQ_WEIGHTS.items() if d in scores.columns]
    out = scores.withColumn("composite", F.round(X.weighted(terms), 4))
    return out.withColumn("status", X.score_label(F.col("composite")))


def quality_summary(report: DataFrame) -> DataFrame:
    """Datasets by status, lowest and mean composite score."""
    return report.agg(
        F.count(F.lit(1)).alias("total_datasets"),
        F.count_if(F.col("status") == "PASS").alias("pass"),
        F.count_if(F.col("status") == "WARN").alias("warn"),
        F.count_if(F.col("status") == "FAIL").alias("fail"),
        F.min("composite_score").alias("min_score"),
        F.round(F.avg("composite_score"), 2).alias("avg_score"))


def quality_dimensions(report: DataFrame) -> DataFrame:
    """The report in long form: one row per dataset and dimension."""
    cells = F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(f"{d}_score").alias("score"), F.col(f"{d}_label").alias("label"),
                 F.col(f"{d}_issues").alias("issues")) for d in DIMENSIONS])
    return report.select("dataset_name", F.inline(cells))


def quality_gate(report: DataFrame) -> list[str]:
    """Stop on any FAIL; return the datasets that only warn. The report has one row per dataset."""
    rows = report.filter("status <> 'PASS'").select("dataset_name", "status").collect()
    failed = sorted(r.dataset_name for r in rows if r.status == "FAIL")
    if failed:
        raise QualityGateError(f"data quality FAIL: {', '.join(failed)}")
    return sorted(r.dataset_name for r in rows)


def quality_gates(report: DataFrame) -> DataFrame:
    """What the gate decides, a row per dataset: (dataset_name, status, halts, warns)."""
    return report.select("dataset_name", "status", (F.col("status") == "FAIL").alias("halts"),
                         (F.col("status") == "WARN").alias("warns"))
