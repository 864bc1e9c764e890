"""Substring dedup: words under a window of words that also starts elsewhere are removed.

Windows are found by hashes, in parts; no suffix tree is built (README says why).
Equal windows share the hash of their words. They meet in the part of a phrase of
eight words: the one with the smallest hash inside the window, which equal windows
have in common and neighbouring windows mostly share, so that these travel together,
as one row with a 48-bit label for each. All phrases are counted first. Where a
phrase has more rows than fit into a part in memory, its windows go by the hash of
all their words instead.

Windows that repeat within a task's slice of rows are settled there, and only
the first of them travels: a text that a third of all rows share sends one row a
slice. Two windows are taken as equal if the 64-bit hash of their phrase and the
label agree.

Defined results: a NULL text has no words; texts shorter than a window lose
nothing; rows that repeat id and text are documents of their own and remove each
other; NULL ids are kept. An empty table gives no rows. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subpulse.llm.common import WordHashes, mix64, signed
from subpulse.session import settle

PHRASE = 8
SLICE_WORDS = 500_000
#: Rows of a phrase that one part may hold; at most LONG_PHRASES phrases may exceed it, or the part grows instead.
PART_ROWS, LONG_PHRASES = 4096, 1_000_000
LABEL_BYTES = 6
ROWS = "phrase long, doc_id long, text_key long, at long, labels binary"
SPANS = "doc_id long, text_key long, at int, span int"
REMOVED = "doc_id long, n_words long, n_removed long, kept_text string"
_BASE = 0x9E3779B97F4A7C15


class _Powers:
    """Powers of the base of the rolling hash and of its inverse modulo 2**64, as far as needed."""
    up = down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> None:
        if len(cls.up) < n:
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                values = np.full(2 * n, base, np.uint64)
                values[0] = 1
                setattr(cls, name, np.cumprod(values))


class Slice:
    """Some texts side by side: their suffixes of ``window`` words, the phrases that own them, and their labels."""

    def __init__(self, hashes: list[np.ndarray], window: int):
        words = np.concatenate(hashes)
        lengths = np.array([len(h) for h in hashes])
        self.begins = np.cumsum(lengths) - lengths
        _Powers.to(len(words) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * _Powers.up[:len(words)])])

        def rolled(n: int) -> np.ndarray:
            return mix64((sums[n:] - sums[:-n]) * _Powers.down[:len(words) - n + 1])

        # suffixes that stay inside their text
        counts = np.maximum(lengths - window + 1, 0)
        self.doc = np.repeat(np.arange(len(hashes)), counts)
        self.start = np.arange(counts.sum()) + np.repeat(self.begins - (np.cumsum(counts) - counts), counts)
        if not len(self.start):
            return
        self.label = rolled(window)[self.start]
        # the leftmost smallest phrase among the ``reach`` ones of each window, by doubling
        phrase, reach = rolled(PHRASE), window - PHRASE + 1
        best, width = np.arange(len(phrase)), 1
        while width < reach:
            step = min(width, reach - width)
            left, right = best[:-step], best[step:]
            best = np.where(phrase[left] <= phrase[right], left, right)
            width += step
        self.owner = best[self.start]
        self.phrase = phrase[self.owner]


def _slices(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple[Slice, np.ndarray, np.ndarray]]:
    """Slices of about SLICE_WORDS words with the ids (NULL as masked) and text keys of their texts."""
    words, ids, keys, held = WordHashes(), [], [], []

    def flush():
        out = Slice(held, window), pa.array(ids, pa.int64()), np.array(keys, np.int64)
        return out if len(out[0].start) else None

    size = 0
    for batch in batches:
        for doc_id, key, text in zip(*(batch.column(c) for c in ("doc_id", "text_key", "text")), strict=True):
            found = (text.as_py() or b"").split()
            if len(found) < window:
                continue
            ids.append(doc_id.as_py())
            keys.append(key.as_py())
            held.append(words.of(found))
            size += len(found)
            if size >= SLICE_WORDS:
                if out := flush():
                    yield out
                ids, keys, held, size = [], [], [], 0
    if held and (out := flush()):
        yield out


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"),
                            F.col("text").cast("binary").alias("text"))


def long_phrases(documents: DataFrame, window: int) -> np.ndarray:
    """The sorted phrases with more rows than a part may hold, counted over all documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, _ in _slices(batches, window):
            new = np.ones(len(part.owner), bool)
            new[1:] = part.owner[1:] != part.owner[:-1]
            phrases, n = np.unique(part.phrase[new], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(signed(phrases)), pa.array(n)], ["phrase", "n"])

    counts = settle(_keyed(documents).mapInArrow(count, "phrase long, n long").groupBy("phrase").agg(
        F.sum("n").alias("n")).filter(F.col("n") > 1), "phrases")
    total = counts.agg(F.sum("n")).first()[0] or 0
    most = max(PART_ROWS, total // LONG_PHRASES)
    found = [r.phrase for r in counts.filter(F.col("n") > most).select("phrase").collect()]
    return np.sort(np.array(found, np.int64).view(np.uint64))


def _runs(starts: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each run of consecutive starts in which nothing in ``same`` changes."""
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] != starts[:-1] + 1
    for x in same:
        new[1:] |= x[1:] != x[:-1]
    first = np.flatnonzero(new)
    return first, np.diff(first, append=len(starts))


def _binary(labels: np.ndarray, counts: np.ndarray) -> pa.Array:
    """``counts`` labels a row, as bytes."""
    data = np.ascontiguousarray(labels.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :LABEL_BYTES])
    ends = (np.concatenate([[0], np.cumsum(counts)]) * LABEL_BYTES).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def suffix_rows(documents: DataFrame, long: np.ndarray, window: int) -> DataFrame:
    """Suffixes by phrase: (phrase, doc_id, text_key, at, labels), and repeats already found as rows without labels.

    ``at`` holds the first start and, for repeats found, the number of starts in its upper half.
    """
    shared = documents.sparkSession.sparkContext.broadcast(long)  # at most LONG_PHRASES numbers

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengthened = shared.value
        for part, ids, keys in _slices(batches, window):
            _, first, place, n = np.unique(part.label, return_index=True, return_inverse=True, return_counts=True)
            twice = np.flatnonzero(n[place] > 1)  # repeats within the slice
            at, span = _runs(part.start[twice])
            repeats = twice[at]
            travels = np.zeros(len(part.start), bool)
            travels[first] = True
            alone = np.zeros(len(part.start), bool)
            if len(lengthened):
                where = np.minimum(np.searchsorted(lengthened, part.phrase), len(lengthened) - 1)
                alone = lengthened[where] == part.phrase
            single = np.flatnonzero(travels & alone)
            kept = np.flatnonzero(travels & ~alone)
            run, counts = _runs(part.start[kept], part.owner[kept])
            begin = kept[run]

            def rows(index: np.ndarray, phrase: np.ndarray, spans: np.ndarray | None, labels: pa.Array,
                     part=part, ids=ids, keys=keys) -> pa.RecordBatch:
                doc = part.doc[index]
                place = (part.start[index] - part.begins[doc]).astype(np.int64)
                if spans is not None:
                    place |= spans.astype(np.int64) << 32
                return pa.RecordBatch.from_arrays(
                    [pa.array(signed(phrase)), ids.take(pa.array(doc)), pa.array(keys[doc]), pa.array(place), labels],
                    ["phrase", "doc_id", "text_key", "at", "labels"])

            if len(repeats):
                yield rows(repeats, mix64(part.label[repeats] + np.uint64(1)), span,
                           _binary(np.zeros(0, np.uint64), np.zeros(len(repeats), int)))
            if len(single):
                yield rows(single, mix64(part.label[single]), None,
                           _binary(part.label[single], np.ones(len(single), int)))
            if len(kept):
                yield rows(begin, part.phrase[begin], None, _binary(part.label[kept], counts))

    return _keyed(documents).mapInArrow(cut, ROWS)


def _deep_nodes(window: int):
    """Rows in order of phrase -> the spans of starts whose window more than one place has."""
    def spans(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        phrase, at = (rows.column(c).to_numpy() for c in ("phrase", "at"))
        labels = rows.column("labels").combine_chunks()
        labels = labels.chunk(0) if isinstance(labels, pa.ChunkedArray) else labels
        ends = np.frombuffer(labels.buffers()[1], np.int32)[labels.offset:labels.offset + len(labels) + 1]
        new = np.ones(len(phrase), bool)
        new[1:] = phrase[1:] != phrase[:-1]
        sizes = np.diff(np.flatnonzero(new), append=len(phrase))
        met = np.repeat(sizes, sizes) > 1
        counts = np.diff(ends) // LABEL_BYTES
        row = np.flatnonzero(met & (counts > 0))
        n = counts[row]
        owner = np.repeat(row, n)
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out_row, out_at, out_span = [], [], []
        if len(owner):
            data = np.frombuffer(labels.buffers()[2], np.uint8)
            place = ends[owner] + inside * LABEL_BYTES
            label = np.zeros((len(owner), 8), np.uint8)
            label[:, :LABEL_BYTES] = data[place[:, None] + np.arange(LABEL_BYTES)]
            node = mix64(phrase[owner].view(np.uint64)) ^ label.view("<u8").ravel()
            _, index, reached = np.unique(node, return_inverse=True, return_counts=True)
            deep = np.flatnonzero(reached[index] > 1)
            start = at[owner[deep]] + inside[deep]
            run, length = _runs(start, owner[deep])
            out_row, out_at, out_span = owner[deep][run], start[run], length
        found = np.flatnonzero(counts == 0)  # repeats found before
        index = np.concatenate([found, out_row]).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id").take(pa.array(index)).combine_chunks(),
             rows.column("text_key").take(pa.array(index)).combine_chunks(),
             pa.array(np.concatenate([at[found] & 0x7FFFFFFF, out_at]).astype(np.int32)),
             pa.array(np.concatenate([at[found] >> 32, out_span]).astype(np.int32))],
            ["doc_id", "text_key", "at", "span"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            phrase = batch.column("phrase").to_numpy()
            done = int(np.searchsorted(phrase, phrase[-1]))  # the last phrase may go on in the next batch
            if done or (held and held[-1].column("phrase")[-1].as_py() != phrase[0]):
                yield from spans(pa.Table.from_batches([*held, batch.slice(0, done)]).combine_chunks())
                held = []
            held.append(batch.slice(done))
        if held:
            yield from spans(pa.Table.from_batches(held).combine_chunks())

    return run


def repeats(documents: DataFrame, window: int = 35) -> DataFrame:
    """(doc_id, text_key, at, span): starts ``at`` to ``at + span - 1`` are windows that also start elsewhere."""
    rows = suffix_rows(documents, long_phrases(documents, window), window)
    return (rows.repartition("phrase").sortWithinPartitions("phrase").mapInArrow(_deep_nodes(window), SPANS)
            .distinct())


def remove_repeats(documents: DataFrame, window: int = 35) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed and kept_text, the other words joined by one space."""
    spans = settle(repeats(documents, window).groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("at", "span")).alias("spans")), "repeats")  # as long as one text at most
    spans = spans.select(F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key"), "spans")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, str]] = []
            for text, found in zip(batch.column("text"), batch.column("spans"), strict=True):
                words = (text.as_py() or b"").split()
                covers = np.zeros(len(words) + 1, np.int64)
                for x in found.as_py() or ():
                    covers[x["at"]] += 1
                    covers[x["at"] + x["span"] + window - 1] -= 1
                stays = np.cumsum(covers[:-1]) == 0
                kept = [w for w, s in zip(words, stays.tolist(), strict=True) if s] if found.is_valid else words
                out.append((len(words), len(words) - len(kept), b" ".join(kept).decode()))
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])

    docs = _keyed(documents)
    return (docs.join(spans, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_key") == F.col("of_key")), "left")
            .select("doc_id", "text", "spans").mapInArrow(keep, REMOVED))
