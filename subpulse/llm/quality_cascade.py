"""Quality rules as a short-circuit cascade.

A document is kept if it breaks no rule. The rules run one after another and
stop at the first one broken, so their order decides the cost, never the
result. On a hash sample of the documents each rule's cost (its measured time a
row, beyond reading the rows) and its selectivity (the share of rows it rejects)
are estimated; the cascade then asks first for the most rejections per cost.

Defined results: a NULL or empty text has no words, all its counts are 0, and
it fails the base rule. Ties, repeated rows and NULL ids are rows like any
others. An empty table is ordered by name and gives no rows. Extra columns are
ignored.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subpulse.llm.common import GAP, WORD, id_text
from subpulse.session import settle

WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: Rows of the sample on which the rules are timed; results don't depend on it.
SAMPLE_ROWS = 2000


@dataclass(frozen=True)
class Rule:
    """``broken`` gives a Column that is true for a document to reject; it may use the text and the base counts."""
    name: str
    broken: Callable[[], Column]


# fixed values: the thresholds of the rules, beside those of the base rule
LEAST_WORDS, MOST_REPEATED = 20, 30
MEAN_WORD = (2.0, 16.0)
MOST_SYMBOLS, MOST_DUP_LINES, MOST_CAPITALS, LEAST_LETTERS = 0.10, 0.30, 0.70, 0.60
MOST_MARKED_LINES = 0.90


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _left(pattern: str) -> Column:
    """Characters of the text that match a one-character pattern."""
    return F.length(F.regexp_replace("text", f"[^{pattern}]+", ""))


DEFAULT_RULES = (
    Rule("mean_word_length", lambda: (F.col("word_chars") < F.col("n_words") * MEAN_WORD[0])
         | (F.col("word_chars") > F.col("n_words") * MEAN_WORD[1])),
    Rule("symbols", lambda: _share(F.col("n_symbols"), F.col("word_chars")) > MOST_SYMBOLS),
    Rule("duplicate_lines", lambda: _share(F.col("n_dup_lines"), F.regexp_count("text", F.lit(r"[^\n]+")))
         > MOST_DUP_LINES),
    Rule("capitals", lambda: _share(_left(r"\p{Lu}"), _left(r"\p{L}")) > MOST_CAPITALS),
    Rule("letters", lambda: _share(_left(r"\p{L}\p{M}"), F.col("word_chars")) < LEAST_LETTERS),
    Rule("marked_lines", lambda: _share(F.regexp_count("text", F.lit(r"(?m)^[ \t]*[-*•>|]")),
                                        F.regexp_count("text", F.lit(r"[^\n]+"))) > MOST_MARKED_LINES),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also when ``body`` uses it for each element of an array."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _covered(windows: Column) -> Column:
    """Words under windows that have an equal: in order of place, each adds eight less the overlap with the next."""
    placed = F.array_sort(F.transform(windows, lambda v, i: F.struct(v.alias("hash"), i.alias("at"))))

    def twins(p: Column) -> Column:
        return F.filter(p, lambda x, i: (x["hash"] == F.get(p, i - 1)["hash"]) | (x["hash"] == F.get(p, i + 1)["hash"]))

    def total(at: Column) -> Column:
        new = F.transform(at, lambda a, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - a, F.lit(WINDOW))))
        return F.aggregate(new, F.lit(0), lambda x, y: x + y)

    return _let(placed, lambda p: _let(F.array_sort(F.transform(twins(p), lambda x: x["at"])), total))


def repeated_words(words: Column) -> Column:
    """Words covered by a window of eight that is found twice or more in the text.

    Windows are told apart by a 64-bit hash of their words' hashes. Only texts in
    which a hash repeats are searched for the places.
    """
    def windows(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - WINDOW)
        return F.transform(starts, lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(WINDOW))))

    def count(v: Column) -> Column:
        return F.when(F.size(F.array_distinct(v)) == F.size(v), F.lit(0)).otherwise(_covered(v))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    found = _let(hashes, lambda h: _let(windows(h), count))
    return F.when(F.size(words) > WINDOW, found).otherwise(F.lit(0))


def base_counts(documents: DataFrame) -> DataFrame:
    """(doc_id, text) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(WORD))
    repeated_lines = _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    counted = documents.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn(
        "words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).select(
        "doc_id", "text", F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", GAP, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        repeated_lines.cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"))
    return counted.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS)
                              | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED))


def _seconds(df: DataFrame) -> float:
    started = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def plan_cascade(counted: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES) -> list[tuple[Rule, float, float]]:
    """(rule, cost, share rejected) in the order to run them, from a settled sample of ``base_counts`` rows."""
    shares = counted.agg(*(F.avg(F.coalesce(r.broken(), F.lit(False)).cast("int")).alias(r.name)
                           for r in rules)).first()
    reading = min(_seconds(counted.select(F.length("text"))) for _ in range(2))
    cost = {r.name: max(min(_seconds(counted.select(r.broken().alias("broken"))) for _ in range(2)) - reading, 1e-4)
            for r in rules}
    rated = [(r, cost[r.name], shares[r.name] or 0.0) for r in rules]
    return sorted(rated, key=lambda x: (-x[2] / x[1], x[0].name))


def quality(documents: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: the base counts, base_failed, kept and rejected_by.

    ``rejected_by`` names the first broken rule in the order found on the sample.
    """
    one_in = max(1, documents.count() // max(sample_rows, 1))
    picked = documents.filter(F.pmod(F.xxhash64(id_text("doc_id"), F.lit("rules")), F.lit(one_in)) == 0)
    order = plan_cascade(settle(base_counts(picked), "rule-sample"), rules)
    # coalesce evaluates its arguments one by one and stops at the first that is not NULL
    broken = F.coalesce(F.when(F.col("base_failed"), F.lit("base")),
                        *(F.when(rule.broken(), F.lit(rule.name)) for rule, _, _ in order))
    return (base_counts(documents).withColumn("rejected_by", broken).drop("text")
            .withColumn("kept", F.col("rejected_by").isNull()))
