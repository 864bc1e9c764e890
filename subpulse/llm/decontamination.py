"""Benchmark decontamination: Wu-Manber search for the word sequences of test items in documents.

An item's windows are its runs of ``window`` consecutive words; an item with
fewer words, but not none, is one window. The search steps through a document's
words with the end of a possible window. A shift table says for the block of
words that ends there how far the end may move without passing over a window:
a block that no window holds lets it jump almost a whole window. Where a block
ends some window, the windows are found by their last block and, among these, by
their first, and compared with the document word by word.

The tables are broadcast. Their size is checked: a table holds at most
``MOST_WINDOWS`` windows of words of at most ``LONG_WORD`` bytes (longer words
are represented by their SHA-256 on both sides). A benchmark with more windows is
dealt into several such shards; each is searched for in a pass over all documents
that keeps only what it hit, and the hits of all passes are put together.
Nothing is shuffled with one shard; with several, only hits and slim rows.

Defined results: NULL texts have no words and are not hit; NULL or wordless
items have no windows; rows that repeat an item id are one item; a NULL item id
counts as the empty id; rows that repeat a document id are documents of their
own. An empty table gives no rows, an empty benchmark no hits. Extra columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subpulse.session import settle

#: After A-Z are lower case, a word is a run of ASCII letters, digits and anything beyond ASCII; in bytes and in characters.
WORD, WORD_TEXT = re.compile(rb"[0-9a-z\x80-\xff]+"), r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MOST_WINDOWS, LONG_WORD = 200_000, 64
#: Windows of an item that stand in one row; a longer item is several rows.
PIECE = 1000
#: From so many windows on, two words are too common a block.
MANY_WINDOWS = 20_000
SPANS = "array<struct<first: long, last: long>>"


def words_of(text: bytes) -> list[bytes]:
    words = WORD.findall(text.lower())
    if words and max(map(len, words)) > LONG_WORD:
        words = [w if len(w) <= LONG_WORD else b"\x00" + sha256(w).digest() for w in words]
    return words


class WuManber:
    """Shift and bucket tables for windows of one length."""

    def __init__(self, windows: dict[tuple[bytes, ...], set[str]], length: int, block: int):
        self.length, self.block = length, min(block, length)
        self.most = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[tuple[bytes, ...], list]] = {}
        for window, items in windows.items():
            for end in range(self.block, length + 1):
                part = window[end - self.block:end]
                self.shift[part] = min(self.shift.get(part, self.most), length - end)
            first = self.buckets.setdefault(window[-self.block:], {}).setdefault(window[:self.block], [])
            first.append((list(window), sorted(items)))

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """(first word, items) of every occurrence of a window."""
        length, block, most, shift, buckets = self.length, self.block, self.most, self.shift, self.buckets
        end, n = length, len(words)
        while end <= n:
            last = tuple(words[end - block:end])
            skip = shift.get(last, most)
            if skip:
                end += skip
                continue
            start = end - length
            for window, items in buckets[last].get(tuple(words[start:start + block]), ()):
                if words[start:end] == window:
                    yield start, items
            end += 1


class Searcher:
    """The windows of a shard of items, by length."""

    def __init__(self, pieces: list[tuple[str, list[bytes]]], window: int):
        by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
        for item, words in pieces:
            length = min(window, len(words))
            for at in range(len(words) - length + 1):
                by_length.setdefault(length, {}).setdefault(tuple(words[at:at + length]), set()).add(item)
        n = sum(map(len, by_length.values()))
        self.searches = [WuManber(windows, length, 2 if n < MANY_WINDOWS else 3) for length, windows in by_length.items()]

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[str]]:
        """The spans of words, first and last, that windows cover, merged; and the items that they come from."""
        hits, items = [], set()
        for search in self.searches:
            for start, found in search.occurrences(words):
                hits.append((start, start + search.length - 1))
                items.update(found)
        spans: list[tuple[int, int]] = []
        for first, last in sorted(hits):
            if spans and first <= spans[-1][1] + 1:
                spans[-1] = (spans[-1][0], max(last, spans[-1][1]))
            else:
                spans.append((first, last))
        return spans, sorted(items)


def item_pieces(items: DataFrame, window: int) -> DataFrame:
    """(item, at, words, n_windows): items cut into pieces that share their edges, so that no window is lost."""
    words = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(WORD_TEXT), F.lit(0))
    cut = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words.alias("words")).filter(
        F.size("words") > 0).withColumn("all", F.greatest(F.size("words") - (window - 1), F.lit(1)))
    cut = cut.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("all") - 1, F.lit(PIECE))))
    return cut.select("item", "at", F.slice("words", F.col("at") + 1, PIECE + window - 1).alias("words"),
                      F.least(F.col("all") - F.col("at"), F.lit(PIECE)).alias("n_windows"))


def searched(documents: DataFrame, searcher: Searcher) -> DataFrame:
    """One row per document: doc_id, text_key, n_words, the spans of words that are hit, and the items."""
    shared = documents.sparkSession.sparkContext.broadcast(searcher)  # MOST_WINDOWS windows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = shared.value.search
        for batch in batches:
            n_words, spans, items = [], [], []
            for text in batch.column("text"):
                words = words_of(text.as_py() or b"")
                hit, found = search(words)
                n_words.append(len(words))
                spans.append([{"first": a, "last": b} for a, b in hit])
                items.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(n_words, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                 pa.array(items, pa.list_(pa.string()))], ["doc_id", "text_key", "n_words", "spans", "items"])

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"),
                             F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, f"doc_id long, text_key long, n_words long, spans {SPANS}, items array<string>")


def _merged(spans: Column) -> Column:
    """Spans in order, those that touch or overlap as one."""
    def add(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["first"].alias("first"), F.greatest(last["last"], span["last"]).alias("last"))
        return F.when((F.size(done) > 0) & (span["first"] <= F.try_element_at(done, F.lit(-1))["last"] + 1),
                      F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))
                      ).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.sort_array(spans), F.array().cast(SPANS), add)


def find_items(documents: DataFrame, items: DataFrame, window: int = 10, most_windows: int = MOST_WINDOWS) -> DataFrame:
    """One row per document: doc_id, text_key, n_words, spans (first and last word hit), items (sorted ids)."""
    pieces = settle(item_pieces(items, window), "pieces")
    total = pieces.agg(F.sum("n_windows")).first()[0] or 0
    n_shards = max(1, -(-2 * total // most_windows)) if total > most_windows else 1  # half full, as hashes deal unevenly
    shard = F.pmod(F.xxhash64("item", "at"), F.lit(n_shards))

    def shard_of(k: int) -> Searcher:
        rows = pieces.filter(shard == k).select("item", "words").distinct().collect()
        return Searcher([(r["item"], words_of(" ".join(r["words"]).encode())) for r in rows], window)

    if n_shards == 1:
        return searched(documents, shard_of(0))
    everyone = settle(searched(documents, shard_of(0)), "searched")
    key = F.struct("doc_id", "text_key").alias("key")
    passes = [everyone] + [settle(searched(documents, shard_of(k)).filter(F.size("spans") > 0), "hits")
                           for k in range(1, n_shards)]
    hits = None
    for found in passes:  # equal rows have equal hits: one of them is enough
        one = found.filter(F.size("spans") > 0).select(key, "spans", "items").groupBy("key").agg(
            F.any_value("spans").alias("spans"), F.any_value("items").alias("items"))
        hits = one if hits is None else hits.unionByName(one)
    hits = settle(hits.groupBy("key").agg(
        _merged(F.flatten(F.collect_list("spans"))).alias("all_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("all_items")), "hits")
    return everyone.withColumn("key", key).join(hits, "key", "left").select(
        "doc_id", "text_key", "n_words", F.coalesce("all_spans", "spans").alias("spans"),
        F.coalesce("all_items", "items").alias("items"))


def n_hit(spans: str = "spans") -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)


def clean(documents: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``documents`` in which no window of an item occurs."""
    hit = settle(find_items(documents, items, window).filter(F.size("spans") > 0).select("doc_id", "text_key").distinct()
                 .toDF("_id", "_text_key"), "contaminated")
    return documents.join(hit, F.col("doc_id").cast("long").eqNullSafe(F.col("_id"))
                          & (F.xxhash64("text") == F.col("_text_key")), "left_anti")
