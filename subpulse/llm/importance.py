"""Target-distribution importance resampling: draw the documents that look most like a target corpus.

Features are runs of consecutive words, hashed into buckets. What a bucket is
worth is how much more often the target has it than the documents have; a
document's weight is the mean worth of its features. Adding Gumbel noise and
taking the highest scores draws without replacement.

Tasks work on batches of texts: the texts are joined with a sentinel between
them that no word can hold, one regex pass finds all words, ``searchsorted`` on
the documents' offsets tells whose each word is, runs that reach over a sentinel
are masked, and ``bincount`` counts the rest. A batch is cut where it holds more
than ``JOINED`` bytes, so memory is bounded by that and by the longest text.

The counts of buckets and of scores go to the driver; both are bounded, the
first by their number, the second by the range of the scores (whole thousandths
of a logarithm: well below 100,000 values). Only documents with the scores that
are drawn are ordered, each score on its own; rows that repeat an id are counted
before they are ordered, so no task meets all of them.

Defined results: a NULL text has no words; without features the weight is 0;
NULL ids draw their noise as the empty text and come last among ties; rows that
repeat an id share its noise and have ranks of their own; rows of one id and
score whose other figures differ stand by n_features. An empty table gives no
rows, an empty target gives every bucket its worth against no occurrences. Extra
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subpulse.llm.common import id_text
from subpulse.session import settle

#: After A-Z are lower case, a word is a run of ASCII letters, digits and anything beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SENTINEL = b"\x00"
#: Bytes of text that are joined at once, and words whose checksum a worker keeps before it starts anew.
JOINED, MOST_KNOWN = 1 << 20, 300_000
DRAWS = 4294967296


@dataclass(frozen=True)
class Features:
    """All runs of ``least`` to ``most`` consecutive words, in ``buckets`` buckets."""
    least: int = 1
    most: int = 1
    buckets: int = 10_000


class Checksums(dict):
    """word -> crc32, computed once per distinct word. Emptied when full, so memory stays bounded."""

    def __missing__(self, word: bytes) -> int:
        value = crc32(word)
        if len(word) <= 64:
            if len(self) >= MOST_KNOWN:
                self.clear()
            self[word] = value
        return value


def _joinable(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The texts in groups of at most ``JOINED`` bytes, or one longer text alone."""
    group, held = [], 0
    for text in texts:
        if group and held + len(text) > JOINED:
            yield group
            group, held = [], 0
        group.append(text)
        held += len(text)
    if group:
        yield group


def hashed_features(texts: list[bytes], features: Features, known: Checksums) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document (its place in ``texts``) and bucket of every feature, and each document's number of words."""
    joined = SENTINEL.join(texts).lower()
    offsets = np.cumsum([0, *(len(text) + 1 for text in texts)])[:-1]
    spans = np.fromiter((x for m in WORD.finditer(joined) for x in m.span()), np.int64).reshape(-1, 2)
    owner = np.searchsorted(offsets, spans[:, 0], "right") - 1
    words = [joined[a:b] for a, b in spans.tolist()]
    sums = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    owners, buckets = [], []
    for n in range(1, features.most + 1):
        if n > 1:  # the checksum of a run goes on from that of the run without its last word
            sums = np.fromiter((crc32(b" " + w, s) for w, s in zip(words[n - 1:], sums.tolist())), np.int64)
        if n >= features.least:
            whole = owner[n - 1:] == owner[:max(len(owner) - n + 1, 0)]  # not over the end of a document
            owners.append(owner[:len(whole)][whole])
            buckets.append(sums[:len(whole)][whole] % features.buckets)
    return np.concatenate(owners), np.concatenate(buckets), np.bincount(owner, minlength=len(texts))


def bucket_counts(rows: DataFrame, features: Features, text: str = "text") -> np.ndarray:
    """How many features of all texts are in each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, known = np.zeros(features.buckets, np.int64), Checksums()
        for batch in batches:
            for texts in _joinable([x.as_py() or b"" for x in batch.column(0)]):
                counts += np.bincount(hashed_features(texts, features, known)[1], minlength=features.buckets)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(counts[met], pa.int64())], ["bucket", "n"])

    found = (rows.select(F.col(text).cast("binary").alias("text")).mapInArrow(run, "bucket long, n long")
             .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros(features.buckets, np.int64)
    for r in found:
        counts[r.bucket] = r.n
    return counts


def gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """What each bucket is worth, in whole thousandths."""
    ratio = (target + 1.0) * (source.sum() + float(len(source))) / ((source + 1.0) * (target.sum() + float(len(target))))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(documents: DataFrame, worth: np.ndarray, features: Features) -> DataFrame:
    """One row per document: doc_id, text_key, n_words, n_features and weight, the floored mean of its features' gains."""
    shared = documents.sparkSession.sparkContext.broadcast(worth)  # one number a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, worth = Checksums(), shared.value.astype(float)
        for batch in batches:
            columns = []
            for texts in _joinable([x.as_py() or b"" for x in batch.column("text")]):
                owner, bucket, n_words = hashed_features(texts, features, known)
                n = np.bincount(owner, minlength=len(texts))
                total = np.bincount(owner, worth[bucket], minlength=len(texts)).astype(np.int64)  # whole: exact below 2^53
                columns.append((n_words, n, total // np.maximum(n, 1)))
            numbers = [pa.array(np.concatenate(x), pa.int64()) for x in zip(*columns)] or [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), *numbers],
                                             ["doc_id", "text_key", "n_words", "n_features", "weight"])

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"),
                             F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, "doc_id long, text_key long, n_words long, n_features long, weight long")


def scored(weights: DataFrame, seed: int) -> DataFrame:
    """``weights`` with ``score``: the weight plus Gumbel noise that the seed and the id determine."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), id_text("doc_id")), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(float(DRAWS)))))
    return weights.withColumn("score", F.col("weight") + noise)


def ranked(scores: DataFrame, percent: int, least_words: int) -> DataFrame:
    """``scores`` with ``rank``: 1, 2, 3 ... for those drawn, in order of score and id, else NULL."""
    scores = settle(scores, "scores")
    enough = F.col("n_words") >= least_words
    counts = sorted(scores.filter(enough).groupBy("score").count().collect(), reverse=True)
    wanted, above, before = sum(r["count"] for r in counts) * percent // 100, [], 0
    for score, n in counts:
        if before >= wanted:
            break
        above.append((score, before))
        before += n
    if not above:
        return scores.withColumn("rank", F.lit(None).cast("long"))
    drawn = enough & (F.col("score") >= above[-1][0])
    above = F.broadcast(scores.sparkSession.createDataFrame(above, "score long, above long"))
    # equal rows are counted first, in slices of a file's rows, then ordered within their score
    alike = [c for c in scores.columns if c != "score"]
    slices = (scores.withColumn("slice", F.shiftright(F.monotonically_increasing_id(), 16)).filter(drawn)
              .groupBy("score", *alike, "slice").agg(F.count(F.lit(1)).alias("n")))
    earlier = (Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "n_features", "text_key", "slice")
               .rowsBetween(Window.unboundedPreceding, -1))
    placed = slices.join(above, "score").withColumn(
        "before", F.col("above") + F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    rank = F.col("before") + F.col("nth")
    ordered = placed.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).select(
        *scores.columns, F.when(rank <= wanted, rank).alias("rank"))
    return ordered.unionByName(scores.filter(~drawn).withColumn("rank", F.lit(None).cast("long")))


def resample(documents: DataFrame, target: DataFrame, features: Features = Features(), percent: int = 10,
             least_words: int = 20, seed: int = 2024) -> DataFrame:
    """One row per document: doc_id, text_key, n_words, n_features, weight, score and rank."""
    worth = gains(bucket_counts(target, features), bucket_counts(documents, features))
    return ranked(scored(weighed(documents, worth, features), seed), percent, least_words)


def drawn(documents: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The rows of ``documents`` that are drawn. Rows that repeat both id and text are drawn together."""
    taken = settle(resample(documents, target, **how).filter("rank IS NOT NULL").select("doc_id", "text_key").distinct()
                   .toDF("_id", "_text_key"), "drawn")
    return documents.join(taken, F.col("doc_id").cast("long").eqNullSafe(F.col("_id"))
                          & (F.xxhash64("text") == F.col("_text_key")), "left_semi")
