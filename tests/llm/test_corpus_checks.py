"""Importance resampling, benchmark search and the Merkle manifest against plain Python, on ordinary and awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from subpulse.llm import decontamination, importance, merkle
from subpulse.llm.queries import QUERIES
from tests.llm.conftest import crc

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_words(text):
    return PLAIN.findall((text or "").translate(UPPER))


def read(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


# importance resampling

def brute_force_draw(docs, target, least=1, most=1, buckets=10_000, percent=10, least_words=20):
    def buckets_of(text):
        w = plain_words(text)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(least, most + 1)
                for i in range(len(w) - n + 1)]

    s, t = (Counter(b for text in texts for b in buckets_of(text)) for texts in ([x for _, x in docs], target))
    n_s, n_t = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text in docs:
        found = buckets_of(text)
        gain = sum(math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets))))
                   for b in found)
        weight = gain // len(found) if found else 0
        h = int(sha(f"2024:{'' if doc_id is None else doc_id}")[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(found), weight, score, len(plain_words(text))))
    able = sorted((r for r in rows if r[4] >= least_words),
                  key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    ranks = Counter()
    for rank, r in enumerate(able[:percent * len(able) // 100], 1):
        ranks[(*r[:4], rank)] += 1
    rest = Counter((*r[:4], None) for r in rows)
    for row, n in ranks.items():
        rest[(*row[:4], None)] -= n
    return +(ranks + rest)


@pytest.mark.parametrize(("least", "most", "buckets"), [(1, 1, 10_000), (1, 2, 512), (2, 4, 97)])
def test_draw_against_brute_force(spark, monkeypatch, least, most, buckets):
    """Also with joined batches of few bytes, so that texts and words lie on every kind of edge."""
    docs, target = read(spark, "documents"), read(spark, "benchmark")
    monkeypatch.setattr(importance, "JOINED", 700)
    got = importance.resample(docs, target, importance.Features(least, most, buckets))
    want = brute_force_draw([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()],
                            least, most, buckets)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in got.collect()) == want


def test_draw_on_awkward_rows(spark, awkward, nothing):
    target = spark.createDataFrame([("one two three",), (None,), ("",)], "text string")
    rows = awkward.union(awkward.filter("doc_id IS NULL").limit(1)).unionByName(awkward.filter("doc_id = 2"))
    want = brute_force_draw([(r.doc_id, r.text) for r in rows.collect()], ["one two three"], percent=60)
    got = importance.resample(rows, target, percent=60)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in got.collect()) == want
    assert importance.resample(nothing, target).count() == 0
    assert importance.resample(rows, target.limit(0), percent=60).filter("rank IS NOT NULL").count() > 0
    assert importance.resample(rows, target, percent=0).filter("rank IS NOT NULL").count() == 0
    kept = importance.drawn(rows, target, percent=100)
    assert kept.columns == rows.columns
    assert kept.count() == sum(len(plain_words(r.text)) >= 20 for r in rows.collect())


def test_draw_with_one_id_for_many_rows(spark):
    """A third of the rows repeat one id and text: ranks still go on without a gap."""
    text = "alpha beta gamma delta " * 6
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"),
                                    F.lit(text).alias("text"))
    got = importance.resample(rows, rows.limit(1), percent=50).collect()
    ranks = sorted((r.rank, r.score, r.doc_id) for r in got if r.rank)
    assert [r for r, _, _ in ranks] == list(range(1, 1501))
    assert all(a[1] > b[1] or (a[1] == b[1] and a[2] <= b[2]) for a, b in zip(ranks, ranks[1:]))


# benchmark decontamination

def brute_force_hits(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = plain_words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add("" if item is None else str(item))
    lengths, out = {len(w) for w in windows}, []
    for doc_id, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        out.append((doc_id, len(w), len(hit), tuple(sorted(found))))
    return Counter(out)


def hits(found):
    return Counter((r.doc_id, r.n_words, sum(s["last"] - s["first"] + 1 for s in r.spans), tuple(r["items"]))
                   for r in found.collect())


def test_search_against_brute_force(spark):
    docs, items = read(spark, "documents"), read(spark, "benchmark")
    want = brute_force_hits([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert hits(decontamination.find_items(docs, items)) == want
    assert any(n for _, _, n, _ in want)
    got = {(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
           for r in QUERIES["op12_decontamination"](spark, SMALL).collect()}
    assert got == {(i, n, h, len(found), sha(",".join(found)), h > 0) for i, n, h, found in want}
    kept = decontamination.clean(docs, items)
    assert {r.doc_id for r in kept.collect()} == {i for i, _, h, _ in want if not h} and kept.columns == docs.columns


AWKWARD_ITEMS = [
    (1, "ten nine eight"), (2, "ONE two, three"), (None, "one two three four five six seven eight nine ten one"), (3, None),
    (4, ""), (5, "..."), (6, "short"), (6, "text with that id"), (10, "x" * 50_000), (11, "ünïcödé wörds"),
    (12, "ÜNÏCÖDÉ"), (7, "w3x3 w4x4 w5x5 w6x6 w7x7 w8x8 w9x9 w10x10 w11x11 w12x12 w13x13 w14x14"), (8, "three four five six"),
    (9, "five five five five"), (20, " ".join(f"w{i % 997}x{i}" for i in range(5000, 9000)))]


@pytest.mark.parametrize("most_windows", [200_000, 900])
def test_search_on_awkward_rows_in_one_or_many_shards(spark, awkward, nothing, most_windows):
    """Few windows a shard: long items are cut into pieces, and hits come from several passes."""
    items = spark.createDataFrame(AWKWARD_ITEMS, "item_id long, text string").withColumn("words", F.lit("clash"))
    docs = awkward.unionByName(awkward.limit(0)).union(awkward.filter("doc_id = 1"))
    want = brute_force_hits([(r.doc_id, r.text) for r in docs.collect()], AWKWARD_ITEMS)
    assert hits(decontamination.find_items(docs, items, most_windows=most_windows)) == want
    assert hits(decontamination.find_items(docs, items, window=3, most_windows=2 * most_windows)) == brute_force_hits(
        [(r.doc_id, r.text) for r in docs.collect()], AWKWARD_ITEMS, 3)
    assert decontamination.find_items(nothing, items, most_windows=most_windows).count() == 0
    assert not any(h for _, _, h, _ in hits(decontamination.find_items(docs, items.limit(0))))


def test_shifts_never_pass_over_a_window():
    """Sequences over few words, where blocks repeat in windows and between them."""
    import random
    rng = random.Random(4)
    for length in (1, 2, 3, 5, 9):
        for block in (1, 2, 3):
            windows = {tuple(rng.choice([b"a", b"b", b"c"]) for _ in range(length)): {str(i)} for i in range(4)}
            words = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(600)]
            got = [at for at, _ in decontamination.WuManber(windows, length, block).occurrences(words)]
            assert got == [i for i in range(len(words) - length + 1) if tuple(words[i:i + length]) in windows]


# Merkle manifest

def brute_force_manifest(rows):
    def leaf(r, text):
        parts = (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)
        return sha("".join("-" if p is None else f"{len(str(p).encode())}:{p}" for p in parts))

    def tree(nodes):
        """The top of a tree, and for each of its leaves the (left, right) siblings on the way."""
        ways, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for way, i in zip(ways, at):
                first = i // 8 * 8
                way.append(("".join(nodes[first:i]), "".join(nodes[i + 1:first + 8])))
            nodes, at = [sha("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)], [i // 8 for i in at]
        return nodes[0], ways

    by_lang = {}
    for r in rows:
        by_lang.setdefault(r["lang"], []).append((leaf(r, r["text"]), r))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        by_lang[lang].sort(key=lambda x: (x[1]["doc_id"] is not None, x[1]["doc_id"] or 0, x[0]))
    trees = [tree([x for x, _ in by_lang[lang]]) for lang in langs]
    root, tops = tree([t for t, _ in trees]) if trees else (None, [])
    out = []
    for lang, (subroot, ways), top in zip(langs, trees, tops):
        for (digest, r), way in zip(by_lang[lang], ways):
            claimed = digest
            if crc(r["doc_id"], 3) == 0:
                claimed = leaf(r, r["text"] and r["text"].translate(UPPER))
            siblings = sha("".join(a + b for a, b in way + top))
            for a, b in way + top:
                claimed = sha(a + claimed + b)
            out.append((r["doc_id"], digest, subroot, root, siblings, claimed, claimed == root))
    return Counter(out)


def manifest_query(spark, rows, folder):
    rows.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    found = QUERIES["op13_merkle_manifest"](spark, str(folder))
    return Counter(map(tuple, found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                           "verified").collect()))


def test_manifest_on_awkward_rows(spark, awkward, nothing, tmp_path):
    assert manifest_query(spark, awkward, tmp_path) == brute_force_manifest(awkward.collect())
    assert not manifest_query(spark, nothing, tmp_path)


@pytest.mark.parametrize(("n", "langs"), [(1, 1), (5, 1), (8, 1), (9, 1), (9, 9), (65, 2), (600, 1), (700, 70)])
def test_manifest_of_trees_of_many_shapes(spark, tmp_path, monkeypatch, n, langs):
    """One leaf, one family, families with one child, many languages; with nodes broadcast and joined."""
    monkeypatch.setattr(merkle, "FEW", 4 if n > 100 else 4096)
    rows = spark.range(n).select(
        F.when(F.col("id") % 7 == 5, None).otherwise(F.col("id") * 37 % 101).alias("doc_id"),
        F.when(F.col("id") % 50 == 0, "Ab").otherwise(F.concat(F.lit("Text "), F.col("id"))).alias("text"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("ä"), F.col("id") % langs)).otherwise(
            F.when(F.lit(langs == 1), "ä0")).alias("lang"),
        F.lit("s").alias("source"), F.col("id").alias("n_chars"))
    got = manifest_query(spark, rows, tmp_path)
    assert got == brute_force_manifest(rows.collect())
    assert len({r[3] for r in got}) == 1 and (n == 1 or {r[6] for r in got} == {True, False})


def test_manifest_with_one_row_many_times(spark, tmp_path):
    rows = spark.range(900).select(F.lit(3).cast("long").alias("doc_id"), F.lit("Same").alias("text"), F.lit("en").alias("lang"),
                                   F.lit("s").alias("source"), F.lit(4).cast("long").alias("n_chars"))
    got = manifest_query(spark, rows, tmp_path)
    assert got == brute_force_manifest(rows.collect())
