"""N-gram Jaccard join with PartEnum signatures: near-duplicate documents and the groups they form.

A document is the set of its word n-grams. Sets are put into bands of similar
size. Within a band, and from the top of the band below, a pair can only be
similar enough if its sets differ in at most k elements. The domain of n-gram
hashes is cut into first-level partitions, more than k / 2 of them, so in one of
them at most one element differs; each is cut into three, so two of those three
are equal. A signature is the content of two of the three: similar sets share
one. Spare first-level partitions make up for contents that are empty on both
sides. A set with more empty places than that cuts the domain anew, by other
hashes, and signs that too: a pair is found by the first cut in which one of its
sets has few empty places. The smallest sets sign by elements, as many as they
could not all miss.

Equal sets are one node, however many documents have them. Each node is compared
first with the node that shares most signatures among those it meets, and the
links found are contracted into groups: copies of one original, however many, are
one group after as many comparisons. Of what shares a signature and is not yet
one group, up to ``LEAF`` nodes are compared with each other. Where there are more,
nodes with too many elements that no other node has are left out, once and for all
hubs. The others are compared with one of them, the hub, that has the fewest such
elements, so it is near the middle of its copies, and keep only what they differ
in from it. Neither of two such nodes is alike to the other unless they share
enough of these differences, so they are joined on their rarest ones (as many as
they could not all miss) and only where what follows can still reach the overlap
needed. No signature makes all pairs of a group, and no link between groups is lost.

Before sets are compared, sketches rule out pairs that differ too much: one bit
per partition of the domain, twice as many as the set has elements, tells
whether the number of elements there is odd. They can not rule out a similar
pair. A set travels only for pairs that sketches leave open, and once for each
hub.

Signatures that very many nodes share are known from a sample of documents. Their
rows need not meet to be told that they do; the sample decides only where rows
go, not what is found.

Comparisons are exact on 64-bit n-gram hashes. Nodes are 64-bit digests of whole
sets; two sets with one digest are noticed by a second digest and refused.

Defined results: NULL texts and texts without a word have an empty set and are
linked with nothing; texts with fewer words than n are one n-gram; NULL ids are
never the smallest of a group unless all its ids are NULL; rows that repeat an
id are documents of their own. An empty table gives no rows. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subpulse.llm.common import WordHashes, discard, lookup, mix64, settle_lean, signed
from subpulse.llm.components import components
from subpulse.session import settle

SPARE = 2
#: Sets of so many elements sign by elements; larger ones cut the domain anew where too much of it is empty, so often.
TINY, TRIALS = 12, 8
FIRST_OF_TWO, SECOND_OF_TWO = [0, 0, 1], [1, 2, 2]
DIGESTED = "doc_id long, text_key long, node long, proof long, n_shingles long, sketch binary"
DIFFERING = ("hub long, node long, root long, n long, d long, out long, alike boolean, "
             "beyond array<long>, lacking array<long>")
LEAST_SKETCH = 512
#: Nodes of a signature that are compared with each other; where there are more, differences from a hub decide.
LEAF = 16
#: One document in so many tells which signatures are frequent: those with more than a share of all rows, fewer than MOST_HOT.
SAMPLED, HOT_SIGNATURE, MOST_HOT, SALTS = 64, 500, 10_000, 100


@dataclass(frozen=True)
class Likeness:
    """Word n-grams of ``words``; sets are alike if their Jaccard similarity is at least ``least`` / ``of``."""
    words: int = 5
    least: int = 80
    of: int = 100

    def band(self, size: int) -> tuple[int, int, int]:
        """(number, smallest, largest size) of the band that a size is in."""
        return next(b for b in reversed(_bands(self, size)) if b[1] <= size)

    def differences(self, largest: int) -> int:
        """How many elements two alike sets of at most this size differ in."""
        return (self.of - self.least) * 2 * largest // (self.of + self.least)


@lru_cache(maxsize=4096)
def _bands(like: Likeness, size: int) -> list[tuple[int, int, int]]:
    """Bands up to the one with ``size`` and one more; each reaches at least as far as a set's largest partner."""
    bands, low = [], 1
    while low <= size or len(bands) < 2 or bands[-1][1] <= size:
        high = max(low, low * 5 // 4, low * like.of // like.least)
        bands.append((len(bands), low, high))
        low = high + 1
    return bands


def shingles(text: bytes, words: int, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct hashes of a text's word n-grams."""
    h = hashes.of(text.split())
    if not len(h):
        return h
    n = min(words, len(h))
    rolled = mix64(h + np.uint64(n))
    for j in range(1, n):
        rolled = mix64(rolled[:len(h) - j] ^ (h[j:] * np.uint64(2 * j + 1)))
    return np.unique(rolled)


@lru_cache(maxsize=256)
def _edges(parts: int) -> np.ndarray:
    return np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)


def _running(shingle_set: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(shingle_set) + 1, np.uint64)
    np.cumsum(mix64(shingle_set), out=sums[1:])
    return sums


def _contents(shingle_set: np.ndarray, running: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """The content of each second-level partition, as one number, and which hold nothing; (first, 3) each."""
    # a partition is a range of hashes, so the set's part in it is a slice, summed up by differences of running sums
    at = np.zeros(3 * first + 1, np.int64)
    at[1:-1], at[-1] = np.searchsorted(shingle_set, _edges(3 * first)), len(shingle_set)
    content = np.diff(running[at]) + np.arange(3 * first, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix64(content).reshape(first, 3), np.diff(at).reshape(first, 3) == 0


def signatures(shingle_set: np.ndarray, like: Likeness) -> np.ndarray:
    """The signatures of a sorted set, for its own band and, if a partner may be there, for the next."""
    size = len(shingle_set)
    bands = _bands(like, size)
    own = like.band(size)[0]
    out, running = [], None
    for number, low, high in bands[own:own + 2]:
        k = like.differences(high)
        if not k or (number > own and size * like.of < like.least * low):
            continue  # only equal sets are alike there, or none can be
        if high <= TINY:
            needed = -(-size * like.least // like.of)
            out.append(mix64(shingle_set[:size - needed + 1] ^ np.uint64(number)))
            continue
        spare = max(SPARE, (k // 2 + 1) // 8)
        first, trial_set = k // 2 + 1 + spare, shingle_set
        running = trial_running = _running(shingle_set) if running is None else running
        for trial in range(TRIALS):
            content, empty = _contents(trial_set, trial_running, first)
            kind = np.uint64(3 * (number * TRIALS + trial))
            two = mix64(content[:, FIRST_OF_TWO] + content[:, SECOND_OF_TWO] + (kind + np.arange(3, dtype=np.uint64)))
            nothing = empty[:, FIRST_OF_TWO] & empty[:, SECOND_OF_TWO]
            enough = np.count_nonzero(nothing.any(1)) <= spare
            out.append(two[~nothing] if enough or trial < TRIALS - 1 else two.ravel())
            if enough:
                break
            trial_set = np.sort(mix64(shingle_set + np.uint64(trial + 1)))
            trial_running = _running(trial_set)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def digest(shingle_set: np.ndarray) -> tuple[int, int]:
    """Two independent digests of a set."""
    total = np.uint64(len(shingle_set)) + np.array([mix64(shingle_set ^ np.uint64(s)).sum(dtype=np.uint64)
                                                    for s in (0x1234567, 0x89ABCDEF)])
    node, proof = signed(mix64(total))
    return int(node), int(proof)


def sketch(shingle_set: np.ndarray) -> bytes:
    """For each of at least twice as many partitions as there are elements, whether it holds an odd number of them.

    Every partition in which two sketches differ holds at least one element that
    the sets differ in, so sketches never rule out a similar pair. The halves of a
    sketch make the sketch of half as many partitions.
    """
    parts = max(LEAST_SKETCH, 1 << (2 * len(shingle_set) - 1).bit_length())
    odd = np.bincount((shingle_set & np.uint64(parts - 1)).astype(np.int64), minlength=parts) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _differing(a: bytes, b: bytes) -> int:
    """In how many partitions two sketches differ: the sets differ in at least as many elements."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) != len(y):
        if len(x) > len(y):
            x = x[:len(x) // 2] ^ x[len(x) // 2:]
        else:
            y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def _sizes_fit(n_a: Column, n_b: Column, like: Likeness) -> Column:
    return (n_a * like.of >= n_b * like.least) & (n_b * like.of >= n_a * like.least)


def _may_be_alike(like: Likeness):
    """Rows (a, b, n_a, n_b, sketch_a, sketch_b) -> the (a, b) that sketches leave open."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = (batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()) * (like.of - like.least)
            differing = [_differing(x.as_py(), y.as_py())
                         for x, y in zip(batch.column("sketch_a"), batch.column("sketch_b"), strict=True)]
            stays = pa.array(np.array(differing, np.int64) * (like.of + like.least) <= both)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(stays) for c in "ab"], ["a", "b"])

    return run


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"),
                            F.col("text").cast("binary").alias("text"))


def digested(documents: DataFrame, like: Likeness) -> DataFrame:
    """Each document's node, its second digest, its size and its sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes(lower=True)
        for batch in batches:
            sets = [shingles(text.as_py() or b"", like.words, hashes) for text in batch.column("text")]
            both = [digest(x) if len(x) else (None, None) for x in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array([d for d, _ in both], pa.int64()),
                 pa.array([d for _, d in both], pa.int64()), pa.array([len(x) for x in sets], pa.int64()),
                 pa.array([sketch(x) if len(x) else None for x in sets], pa.binary())],
                ["doc_id", "text_key", "node", "proof", "n_shingles", "sketch"])

    return _texts(documents).mapInArrow(run, DIGESTED)


def signed_nodes(documents: DataFrame, like: Likeness, hot: np.ndarray | None = None) -> DataFrame:
    """(signature, salt, node): a node signs with its first document in a batch.

    Signatures in ``hot``, sorted, have a salt from 1 to SALTS by their node, all others 0.
    """
    shared = documents.sparkSession.sparkContext.broadcast(np.zeros(0, np.int64) if hot is None else hot)  # MOST_HOT numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, known = WordHashes(lower=True), shared.value
        for batch in batches:
            seen, signs, nodes = set(), [], []
            for text in batch.column("text"):
                found = shingles(text.as_py() or b"", like.words, hashes)
                if not len(found) or (node := digest(found)[0]) in seen:
                    continue
                seen.add(node)
                signs.append(signed(signatures(found, like)))
                nodes.append(node)
            if signs:
                signature, node = np.concatenate(signs), np.repeat(nodes, [len(x) for x in signs])
                salt = np.zeros(len(signature), np.int8)
                if len(known):
                    at = np.minimum(np.searchsorted(known, signature), len(known) - 1)
                    salt[known[at] == signature] = 1
                    salt *= (1 + node % SALTS).astype(np.int8)
                yield pa.RecordBatch.from_arrays([pa.array(signature), pa.array(salt), pa.array(node)],
                                                 ["signature", "salt", "node"])

    return documents.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "signature long, salt byte, node long")


def hot_signatures(documents: DataFrame, like: Likeness) -> np.ndarray:
    """The sorted signatures that many nodes of a sample share: they are known to be shared without meeting."""
    some = settle_lean(documents.select("text").filter(F.pmod(F.xxhash64("text", F.lit("sampled")), F.lit(SAMPLED)) == 0)
                       .distinct(), "sampled")
    most = some.count()
    counts = signed_nodes(some, like).groupBy("signature").agg(F.count(F.lit(1)).alias("n")).filter(
        (F.col("n") > 2) & (F.col("n") * HOT_SIGNATURE > most))
    rows = counts.orderBy(F.desc("n"), "signature").limit(MOST_HOT).collect()
    discard(some)
    return np.sort(np.array([r.signature for r in rows], np.int64))


def _with_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (signature, node[, salt]) in order: every further node of a signature, beside the signature's first.

    Of salted signatures every node, beside NULL: the others are elsewhere.
    """
    last_sign = last_first = last_node = None
    for batch in batches:
        if not batch.num_rows:
            continue
        sign, node = (batch.column(i).to_numpy() for i in range(2))
        salted = batch.column(2).to_numpy() > 0 if batch.num_columns > 2 else np.zeros(len(sign), bool)
        new = np.ones(len(sign), bool)
        new[1:] = sign[1:] != sign[:-1]
        before = np.concatenate([node[:1], node[:-1]])
        fresh = new | (node != before)
        firsts = node[new]
        if last_sign is not None and sign[0] == last_sign:  # the first signature goes on from the batch before
            firsts[0], before[0], fresh[0] = last_first, last_node, node[0] != last_node
        first = firsts[np.cumsum(new) - 1]
        again = np.where(salted, fresh, (node != before) & (node != first))
        last_sign, last_first, last_node = sign[-1], first[-1], node[-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(sign[again]), pa.array(first[again], mask=salted[again]), pa.array(node[again])],
            ["signature", "first", "node"])


def _alike(a: str, b: str, like: Likeness) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both * like.of >= (F.size(a) + F.size(b) - both) * like.least


def _sets(documents: DataFrame, wanted: DataFrame, like: Likeness) -> DataFrame:
    """(node, set) for the rows of ``wanted`` (doc_id, ...): their texts are read again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes(lower=True)
        for batch in batches:
            found = [shingles(text.as_py() or b"", like.words, hashes) for text in batch.column("text")]
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest(x)[0] for x in found], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64),
                                                                                   *map(signed, found)])))],
                ["node", "set"])

    ids = wanted.select(F.col("doc_id").alias("wanted_id"))
    return (_texts(documents).join(ids, F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi").select("text")
            .filter("text IS NOT NULL").mapInArrow(run, "node long, set array<long>"))


def _linked(pairs: DataFrame, documents: DataFrame, nodes: DataFrame, like: Likeness,
            built: DataFrame | None = None) -> DataFrame:
    """Those (a, b) of ``pairs`` that are alike. Only sets whose sketches leave it open are built again, unless all are
    ``built`` (node, set, ...).
    """
    sides = [nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))
             for x in "ab"]
    # a may be a hub, with many pairs: its sketch and its set join last
    fit = pairs.join(sides[1], "b").join(sides[0], "a").filter(_sizes_fit(F.col("n_a"), F.col("n_b"), like))
    likely = settle_lean(fit.mapInArrow(_may_be_alike(like), "a long, b long"), "likely")
    sets = built
    if built is None:
        either = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
        sets = settle_lean(_sets(documents, nodes.join(either, "node", "left_semi"), like), "sets")
    set_a = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    set_b = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    links = settle_lean(likely.join(set_b, "b").join(set_a, "a").filter(_alike("set_a", "set_b", like)).select("a", "b"),
                        "links")
    discard(likely, *([sets] if built is None else []))
    return links


def _candidates(met: DataFrame, documents: DataFrame, nodes: DataFrame, like: Likeness) -> DataFrame:
    """(node, root, set, shared) of the nodes of ``met`` (hub, node, root) that can be alike to another one of them;
    ``shared`` is what other nodes have too of a set.

    Of a node's elements an alike node lacks a share of (of - least) / of at most.
    A node with more of them that no other node has is alike to none, whatever
    hubs it meets. Each set is looked at once, and an element that many have is
    only counted.
    """
    own = met.select("node", "root").distinct()
    sets = settle_lean(_sets(documents, nodes.join(own, "node", "left_semi"), like).dropDuplicates(["node"])
                       .join(own, "node"), "sets")
    held = sets.select("node", F.explode("set").alias("element")).groupBy("element").agg(
        F.min("node").alias("node"), F.count(F.lit(1)).alias("held"))
    alone = held.filter("held = 1").groupBy("node").agg(F.collect_list("element").alias("alone"))
    shared = F.when(F.col("alone").isNull(), F.col("set")).otherwise(F.array_except("set", "alone"))
    found = settle_lean(sets.join(alone, "node", "left").select("node", "root", "set", shared.alias("shared")).filter(
        F.size("shared") * like.of >= F.size("set") * like.least), "candidates")
    discard(sets)
    return found


def _stars(met: DataFrame, sets: DataFrame) -> DataFrame:
    """(hub, node) of the nodes in ``sets`` that meet; of all that met one hub, that with the least part of its own is
    the new one. Two nodes that had a hub in common have one again, or are alone with it.
    """
    rank = sets.select("node", F.struct((F.size("shared") / F.size("set")).alias("share"), "node").alias("rank"))
    ranked = settle_lean(met.select("hub", "node").join(rank, "node"), "ranked_met")
    best = settle_lean(ranked.groupBy("hub").agg(F.max("rank").alias("best")), "best")
    stars = settle_lean(ranked.join(best, "hub").select(F.col("best.node").alias("hub"), "node").filter(
        "hub <> node").distinct(), "met_stars")
    discard(ranked, best)
    return stars


def _differences(like: Likeness):
    """Rows (hub, node, root, hub_set, node_set, shared) -> how many elements each node has beyond its hub, those of
    them that other nodes have too, what it lacks of the hub if that can matter, how many elements differ in all, and
    whether node and hub are alike.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, rows = ([], []), []
            for hub, node, shared in zip(batch.column("hub_set"), batch.column("node_set"), batch.column("shared"), strict=True):
                hub, node, shared = (x.values.to_numpy() for x in (hub, node, shared))
                lacking = hub[~np.isin(hub, node, assume_unique=True)]
                out = len(node) - len(hub) + len(lacking)
                d = out + len(lacking)
                matters = out * like.least <= len(node) * (like.of - like.least)
                lists[0].append(shared[~np.isin(shared, hub, assume_unique=True)])
                lists[1].append(lacking if matters else hub[:0])
                rows.append((len(node), d, out, d * (like.of + like.least) <= (len(hub) + len(node)) * (like.of - like.least)))
            n, d, out, alike = zip(*rows, strict=True) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("hub"), batch.column("node"), batch.column("root"), pa.array(n, pa.int64()),
                 pa.array(d, pa.int64()), pa.array(out, pa.int64()), pa.array(alike, pa.bool_()),
                 *(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, x)], dtype=np.int32)),
                                            pa.array(np.concatenate([np.zeros(0, np.int64), *x]))) for x in lists)],
                DIFFERING.replace(" long", "").replace(" boolean", "").replace(" array<long>", "").split(", "))

    return run


def _met(each: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """The rows (key, node, root, ...) whose key nodes of another root have too, and the settled table of these keys."""
    counts = settle_lean(each.groupBy("key").agg(F.count(F.lit(1)).alias("held"), F.min("root").alias("low"),
                                                 F.max("root").alias("high")).filter("low <> high").select("key", "held"), "counts")
    return lookup(each, counts, "key", total, "held"), counts


def _from_hubs(stars: DataFrame, sets: DataFrame, documents: DataFrame, nodes: DataFrame,
               like: Likeness) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) between hubs and nodes of ``stars`` (hub, node, root), and pairs of a hub's nodes that may be alike;
    ``sets`` are those of ``_candidates``.

    Let two nodes differ from their hub in p and q elements and share s of these.
    They differ from each other in p + q - 2 s, which must not exceed the limit,
    so s is at least (p + q - limit) / 2; that is more than 0 unless both are alike
    to the hub, and then they are in one group already. If one is alike to the hub,
    the other one differs from it by more than their limit, so s is larger.

    Elements that no node of another group has come first in order, and those that
    no other node has at all are only counted. What nodes lack of the hub comes
    last, so it matters only to nodes that have little beyond the hub.
    """
    both = (stars.join(sets.select("node", F.col("set").alias("node_set"), "shared"), "node")
            .join(sets.select(F.col("node").alias("hub"), F.col("set").alias("hub_set")), "hub"))
    differ = settle_lean(both.select("hub", "node", "root", "hub_set", "node_set", "shared").mapInArrow(
        _differences(like), DIFFERING), "differences")
    # nodes alike to one hub are one group
    with_hub = differ.filter("alike").select("hub", F.col("root").alias("root_a"))
    through_hub = with_hub.join(with_hub.groupBy("hub").agg(F.min("root_a").alias("root_b")), "hub").drop("hub")
    tops = components(through_hub, "root_a", "root_b").toDF("root", "top")
    grouped = differ.join(tops, "root", "left").withColumn("root", F.coalesce("top", "root")).drop("top")
    # read by several joins, and made once
    each = settle_lean(grouped.select(
        "hub", "node", "root", "n", "d", "out", "alike", F.size("beyond").alias("listed"), F.size("lacking").alias("lacks"),
        F.posexplode(F.concat("beyond", "lacking")).alias("at", "element")).select(
        F.struct("hub", "element").alias("key"), "node", "root", "n", "d", "out", "alike", "lacks",
        (F.col("at") >= F.col("listed")).alias("of_hub")), "each")
    total = each.count()
    met, counts = _met(each, total)
    # rarest first; those that no node of another group has come before all, and need not be joined
    in_order = Window.partitionBy("key.hub", "node", "of_hub").orderBy("held", "key.element")
    n_met = F.count(F.lit(1)).over(Window.partitionBy("key.hub", "node", "of_hub"))
    listed = F.when(F.col("of_hub"), F.col("out") + F.col("lacks")).otherwise(F.col("out"))
    # the elements that any partner may differ in: in all, and of those beyond the hub
    most = F.floor(F.col("n") * (like.of - like.least) / F.when(F.col("of_hub"), like.least).otherwise(like.of))
    # the partner of a node alike to the hub is not, so it has more of its own
    unlike_hub = 2 * F.col("place") * (like.of + like.least) < (
        F.col("d") * (like.of + like.least) + (2 * F.col("out") - F.col("d")) * (like.of - like.least))
    rarest = settle_lean(met.withColumn("place", listed - n_met + F.row_number().over(in_order) - 1)
                         .filter((F.col("place") <= most) & (~F.col("alike") | unlike_hub))
                         .drop("held", "out", "lacks", "of_hub", "alike"), "rarest")
    # those that are alike to each other but not to the hub become groups of their own, again by one hub each
    rank = rarest.groupBy("node").agg(F.struct(F.count(F.lit(1)), "node").alias("rank"))
    ranked = settle_lean(rarest.select("key", "node").join(rank, "node"), "ranked")
    next_hubs = settle_lean(ranked.groupBy("key").agg(F.max("rank").alias("next")), "next_hubs")
    star = ranked.join(next_hubs, "key").groupBy("node").agg(F.max("next").alias("next")).select(
        F.col("next.node").alias("a"), F.col("node").alias("b")).filter("a <> b")
    near = _linked(star, documents, nodes, like, sets)
    own = settle_lean(rarest.select("node", "root").distinct(), "own_roots")
    joined = near.join(own.toDF("a", "root_a"), "a").join(own.toDF("b", "root_b"), "b").select("root_a", "root_b")
    again = components(joined, "root_a", "root_b").toDF("root", "top")
    now = own.join(again, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    apart = settle_lean(rarest.drop("root").join(now, "node"), "apart")
    a, b = (apart.toDF(*[c if c == "key" else f"{x}_{c}" for c in apart.columns]) for x in "ab")
    still = F.least(F.col("a_d") - F.col("a_place"), F.col("b_d") - F.col("b_place"))
    pairs = a.join(b, "key").filter(
        (F.col("a_root") != F.col("b_root")) & (F.col("a_node") < F.col("b_node"))
        & _sizes_fit(F.col("a_n"), F.col("b_n"), like)
        & ((F.col("a_d") + F.col("b_d") - 2 * still) * (like.of + like.least)
           <= (F.col("a_n") + F.col("b_n")) * (like.of - like.least)))
    pairs = settle_lean(pairs.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct(), "pairs")
    links = settle_lean(differ.filter("alike").select(F.col("hub").alias("a"), F.col("node").alias("b")).union(near),
                        "hub_links")
    discard(differ, each, counts, rarest, ranked, next_hubs, own, apart, near)
    return links, pairs


def _members(documents: DataFrame, like: Likeness) -> DataFrame:
    """(signature, node) of every signature that more than one node has."""
    rows = signed_nodes(documents, like, hot_signatures(documents, like)).repartition("signature", "salt")
    met = rows.select("signature", "node", "salt").sortWithinPartitions("signature", "node")
    shared = settle_lean(met.mapInArrow(_with_first, "signature long, first long, node long"), "shared")
    firsts = shared.filter("first IS NOT NULL").select("signature", F.col("first").alias("node")).distinct()
    members = settle_lean(shared.select("signature", "node").union(firsts), "members")
    discard(shared)
    return members


def near_duplicates(documents: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """One row per document: doc_id, text_key, n_shingles, component_id (the smallest id of its group) and keep_key.

    ``keep_key`` is the ``text_key`` of the group's document with that id, the smallest if there are several.
    """
    found_docs = settle(digested(documents, like), "digested")
    best = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    nodes = settle_lean(found_docs.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.min(best).alias("best"), F.count(F.lit(1)).alias("n_docs"),
        F.min("proof").alias("proof"), F.max("proof").alias("other"), F.max("n_shingles").alias("n"),
        F.any_value("sketch").alias("sketch")), "nodes")
    if not nodes.filter("proof <> other").isEmpty():
        raise ValueError("two sets share a 64-bit digest")
    members = _members(documents, like)

    # first each node with the one that shares most signatures with any: of copies of copies that is the original
    rank = members.groupBy("node").agg(F.struct(F.count(F.lit(1)), "node").alias("rank"))
    ranked = settle_lean(members.join(rank, "node"), "ranked")
    hubs = settle_lean(ranked.groupBy("signature").agg(F.max("rank").alias("hub")), "hubs")
    nearest = settle_lean(ranked.join(hubs, "signature").groupBy("node").agg(F.max("hub").alias("hub")), "nearest")
    star = nearest.select(F.col("hub.node").alias("a"), F.col("node").alias("b")).filter("a <> b")
    links = _linked(star, documents, nodes, like)
    roots = components(links)
    discard(ranked, nearest)

    # then what shares a signature across the groups so far
    placed_members = settle_lean(members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "placed")
    discard(members)
    buckets = settle_lean(placed_members.groupBy("signature").agg(
        F.count(F.lit(1)).alias("size"), F.min("node").alias("a"), F.max("node").alias("b"),
        F.bit_xor(F.xxhash64("node")).alias("xor_1"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("xor_2"),
        F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").drop("low", "high"), "buckets")
    # those with the same nodes are one; the nodes are told by their number and two xored hashes
    mixed = settle_lean(buckets.filter("size > 2").groupBy("size", "xor_1", "xor_2").agg(
        F.min("signature").alias("signature")).select("signature", "size"), "mixed")
    open_members = settle_lean(placed_members.join(mixed, "signature").join(nodes.select("node", "n"), "node"), "open")
    few = open_members.filter(F.col("size") <= LEAF).drop("size")
    a, b = (few.toDF(*[c if c == "signature" else f"{x}_{c}" for c in few.columns]) for x in "ab")
    within = a.join(b, "signature").filter(
        (F.col("a_root") != F.col("b_root")) & (F.col("a_node") < F.col("b_node"))
        & _sizes_fit(F.col("a_n"), F.col("b_n"), like)).select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    met = settle_lean(open_members.filter(F.col("size") > LEAF).join(hubs, "signature").select(
        F.col("hub.node").alias("hub"), "node", "root").distinct(), "met")
    # of many nodes those that can be alike to any, first with every hub they meet: what is alike to it is one group
    sets = _candidates(met, documents, nodes, like)
    met_stars = _stars(met, sets)
    near = _linked(met_stars.toDF("a", "b"), documents, nodes, like, sets)
    placed = sets.select("node", "root")
    tops = components(near.join(placed.toDF("a", "root_a"), "a").join(placed.toDF("b", "root_b"), "b").select("root_a", "root_b"),
                      "root_a", "root_b").toDF("root", "top")
    groups = settle_lean(placed.join(tops, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "groups")
    # hubs of one group are one: the one that most nodes are alike to
    n_alike = near.groupBy(F.col("a").alias("hub")).agg(F.count(F.lit(1)).alias("n_alike"))
    group = met_stars.select("hub").distinct().join(groups.toDF("hub", "root"), "hub").join(n_alike, "hub", "left").select(
        "hub", "root", F.struct(F.coalesce("n_alike", F.lit(0)), "hub").alias("rank"))
    top_hubs = group.join(group.groupBy("root").agg(F.max("rank").alias("top")), "root").select(
        "hub", F.col("top.hub").alias("top_hub"))
    stars = settle_lean(met_stars.join(top_hubs, "hub").select(F.col("top_hub").alias("hub"), "node").filter(
        "hub <> node").distinct().join(groups, "node"), "stars")
    hub_links, may_be = _from_hubs(stars, sets, documents, nodes, like)
    across = settle_lean(buckets.filter("size = 2").select("a", "b").union(within).union(may_be).distinct(), "across")
    discard(buckets, mixed, open_members, hubs, met, sets, met_stars, groups, stars, may_be)
    more = _linked(across, documents, nodes, like).union(hub_links).union(near)
    ends = nodes.select("node").join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    joined = (more.join(ends.toDF("a", "root_a"), "a").join(ends.toDF("b", "root_b"), "b").select("root_a", "root_b"))
    tops = components(joined, "root_a", "root_b").toDF("root", "top")
    discard(across, placed_members)

    placed = (nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
              .join(tops, "root", "left").withColumn("root", F.coalesce("top", "root")).drop("top"))
    smallest = placed.groupBy("root").agg(F.min("best").alias("best")).select(
        "root", F.col("best.doc_id").alias("component_id"), F.col("best.text_key").alias("keep_key"))
    facts = settle_lean(placed.select("node", "root", "n_docs").join(smallest, "root").drop("root"), "facts")
    found = found_docs.select("doc_id", "text_key", "node", "n_shingles")
    alone = found.filter("node IS NULL").select("doc_id", "text_key", "n_shingles", F.col("doc_id").alias("component_id"),
                                                F.col("text_key").alias("keep_key"))
    return lookup(found.filter("node IS NOT NULL"), facts, "node", found.count(), "n_docs").select(
        "doc_id", "text_key", "n_shingles", "component_id", "keep_key").unionByName(alone)


def keep_one(documents: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """The rows of ``documents`` without near duplicates: of each group the one with the smallest id stays.

    Rows that repeat both id and text stay together; exact dedup tells them apart.
    """
    verdict = near_duplicates(documents, like)
    stays = settle(verdict.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))
                                  & (F.col("text_key") == F.col("keep_key")))
                   .select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_text_key")), "stays")
    return documents.join(stays, F.col("doc_id").cast("long").eqNullSafe(F.col("_id"))
                          & (F.xxhash64("text") == F.col("_text_key")), "left_semi")
