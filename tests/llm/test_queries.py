"""Registered text queries against SQL, brute force, round trips or held-out labels."""

import base64
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import sentencepiece
from compare import compare, connect
from conftest import MEDIUM, SMALL

import __spark_entry__ as entry
from subpulse.llm import language_id, ngram_join, toxicity
from subpulse.llm.common import id_remainder
from subpulse.llm.queries import QUERIES, toxicity_model
from tests.llm.conftest import crc, words


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").collect()


def rows_of(spark, name, sf=SMALL):
    return QUERIES[name](spark, sf).collect()


def test_all_queries_and_the_pipeline_are_registered():
    found = {int(m[1]) for name in entry.queries() if (m := re.match(r"op(\d+)_", name))}
    assert found == set(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", ["op1_mix_sources", "op4_exact_dedup", "op5_quality_rules", "op11_importance_resampling",
                                  "op12_decontamination", "op13_merkle_manifest"])
def test_against_sql(spark, name):
    for sf in (SMALL, MEDIUM):
        assert compare(spark, connect(sf), sf, name).startswith("OK")


def test_mix_comes_near_its_targets(spark):
    rows = rows_of(spark, "op1_mix_sources", MEDIUM)
    sources = {r.doc_id: r.source for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    taken, target, largest = Counter(), {}, Counter()
    for r in rows:
        s = sources[r.doc_id]
        assert r.taken in (0, r.size, 2 * r.size) and r.target <= 2 * r.source_size
        taken[s] += r.taken
        target[s], largest[s] = r.target, max(largest[s], r.size)
    assert sum(target.values()) == pytest.approx(1.5 * sum(r.size for r in rows))
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 for s in target)


def test_toxicity_on_held_out_rows(spark):
    rows = {r.doc_id: r for r in rows_of(spark, "op2_toxicity", "/root/testdata/sf0.1")}
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    assert all(r.held_out == (crc(i, 4) == 2) and r.predicted == (r.score >= 0.3) for i, r in rows.items())
    held_out = [(toxic[i], rows[i].predicted) for i in toxic if rows[i].held_out]
    assert sum(p for t, p in held_out if t) >= 0.95 * sum(t for t, _ in held_out)
    assert sum(p for t, p in held_out if not t) <= 0.01 * sum(1 - t for t, _ in held_out)


def test_toxicity_against_plain_loops(spark, docs):
    """The same model, word by word and passage by passage."""
    model = toxicity_model(spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet"))

    def score(text):
        every = (text or "").encode().split()
        words = [w for w, before in zip(every, [None, *every]) if w != before]
        if not words:
            return 0.0
        facts = []
        for word in words:
            ids, counts = toxicity.subwords([word])
            facts.append((sum(float(model.slope[i]) for i in ids), int(counts[0])))
        width, free, sums, best = min(toxicity.PASSAGE, len(words)), set(range(len(words))), [0.0, 0], -math.inf
        for k in range(toxicity.WORST):
            left = [i for i in range(len(words) - width + 1) if set(range(i, i + width)) <= free]
            if left:
                at = max(left, key=lambda i: (sum(e for e, _ in facts[i:i + width])
                                              / sum(n for _, n in facts[i:i + width]), -i))
                free -= set(range(at, at + width))
                sums = [sums[0] + sum(e for e, _ in facts[at:at + width]), sums[1] + sum(n for _, n in facts[at:at + width])]
            best = max(best, sums[0] / sums[1] + model.bias[k])
        return 1 / (1 + math.exp(-best))

    got = {r.doc_id: r.score for r in rows_of(spark, "op2_toxicity")}
    some = [r for r in docs if len(r.text or "") < 4000]
    assert len(some) > 100
    for r in some:
        assert got[r.doc_id] == pytest.approx(score(r.text), abs=1e-6)


def test_language_against_plain_compression(spark, docs):
    """The same dictionaries, one text and one compressor at a time."""
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    dictionaries = language_id.learn_dictionaries(df.filter(id_remainder("doc_id", 5) != 0))
    got = {r.doc_id: r.lang_pred for r in rows_of(spark, "op9_language_id")}
    for r in docs:
        letters = regex.sub(r"[^\p{L}]+", " ", (r.text or "").lower())
        if not letters.strip():
            assert got[r.doc_id] == "und"
            continue
        sizes = {lang: language_id.compressed_sizes(letters.encode(), language_id._compressors((content,)))[0]
                 for lang, content in dictionaries.items()}
        assert sizes[got[r.doc_id]] == min(sizes.values())


def brute_force_groups(texts, n, least, of):
    sets = {}
    for i, text in texts.items():
        w = (text or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[j:j + n]) for j in range(max(1, len(w) - n + 1))) if w else frozenset()
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    having = defaultdict(list)
    for i in sorted(sets):
        common = Counter()
        for gram in sets[i]:
            common.update(having[gram])
            having[gram].append(i)
        for j, k in common.items():
            if of * k >= least * (len(sets[i]) + len(sets[j]) - k):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_ngram_join_against_brute_force(spark, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows_of(spark, "op3_ngram_jaccard")}
    assert got == brute_force_groups({r.doc_id: r.text for r in docs}, 3, 90, 100)


@pytest.mark.parametrize(("n", "least"), [(3, 90), (5, 80), (2, 60)])
def test_ngram_join_around_its_threshold(spark, n, least):
    """Families of copies with more and more words changed, so that pairs fall on both sides, in chains."""
    texts, i = {}, 0
    for size in (4, 9, 11, 30, 33, 90, 400):
        base = [f"f{size}w{j}" for j in range(size)]
        for step in range(12):
            for at in range(step):
                base[(at * 7 + step) % size] = f"n{size}s{step}a{at}" if at % 5 == 0 else base[(at * 7 + step) % size]
            texts[i] = " ".join(base[:size - step % 3])
            i += 1
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in ngram_join.near_duplicates(df, ngram_join.Likeness(n, least, 100)).collect()}
    want = brute_force_groups(texts, n, least, 100)
    assert got == want
    assert 1 < len({c for _, c in want.values()}) < len(texts)


def groups_of(spark, texts, like):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(df, like).collect()}


def test_siblings_below_the_threshold(spark):
    """Copies of one text with other words in two places each: all share signatures, few are alike."""
    rng, texts = random.Random(11), {}
    base = [f"b{j}" for j in range(60)]
    for i in range(2000):
        words = list(base)
        for at in rng.sample(range(60), 2):
            words[at] = f"n{rng.randrange(9)}" if i % 3 == 0 else f"s{i}a{at}"
        texts[i] = " ".join(words)
    want = brute_force_groups(texts, 3, 90, 100)
    assert groups_of(spark, texts, ngram_join.Likeness(3, 90, 100)) == want
    assert 1 < len({c for _, c in want.values()}) < len(texts)


@pytest.mark.parametrize(("n", "least"), [(3, 90), (5, 80)])
def test_differences_from_hubs(spark, monkeypatch, n, least):
    """With leaves of two nodes every larger signature goes by its hub; pairs lie on both sides of the threshold."""
    monkeypatch.setattr(ngram_join, "LEAF", 2)
    rng, texts = random.Random(3), {}
    for family in range(12):
        size = rng.choice([13, 14, 20, 40, 41, 90, 300])
        base = [f"f{family}w{j}" for j in range(size)]
        for i in range(25):
            words = list(base)
            for at in rng.sample(range(size), rng.randrange(1 + max(2, size // (8 if n == 5 else 16)))):
                words[at] = rng.choice(["x", "y", f"u{i}"])
            texts[len(texts)] = " ".join(words)
    want = brute_force_groups(texts, n, least, 100)
    assert groups_of(spark, texts, ngram_join.Likeness(n, least, 100)) == want
    assert 12 < len({c for _, c in want.values()}) < len(texts)


def test_texts_that_share_a_passage_only(spark, monkeypatch):
    """Few of their words are looked up among the differences from hubs: most texts have too much that no other has."""
    looked_up, lookup = [], ngram_join.lookup

    def counted(rows, facts, key, *rest):
        found = lookup(rows, facts, key, *rest)
        if key == "key":
            looked_up.append(found.count())
        return found

    monkeypatch.setattr(ngram_join, "lookup", counted)
    passage = " ".join(f"p{j}" for j in range(60))
    texts = {i: passage + " " + " ".join(f"t{i}w{j}" for j in range(80)) for i in range(200)}
    texts |= {200 + i: texts[i].replace(f"t{i}w40 ", "other ") for i in range(20)}
    want = brute_force_groups(texts, 5, 80, 100)
    assert groups_of(spark, texts, ngram_join.Likeness(5, 80, 100)) == want
    assert len(set(c for _, c in want.values())) == 200
    assert looked_up and sum(looked_up) < 20 * len(texts)


def test_cloud_of_near_copies(spark, monkeypatch):
    """Copies of one text with a few words changed, just too many or just not: what one of them lacks is no pair of all."""
    found, from_hubs = [], ngram_join._from_hubs

    def counted(*given):
        links, pairs = from_hubs(*given)
        found.append((given[0].count(), pairs.count()))
        return links, pairs

    monkeypatch.setattr(ngram_join, "_from_hubs", counted)
    rng, base = random.Random(5), [f"b{j}" for j in range(150)]
    texts = {0: " ".join(base)}
    for i in range(1, 400):
        words = base + [f"e{i}a{j}" for j in range(rng.randrange(4))]
        for at in rng.sample(range(150), rng.randrange(3, 6)):
            words[at] = f"s{i}a{at}"
        texts[i] = " ".join(words)
    want = brute_force_groups(texts, 5, 80, 100)
    assert groups_of(spark, texts, ngram_join.Likeness(5, 80, 100)) == want
    assert 1 < len({c for _, c in want.values()}) < len(texts)
    (stars, pairs), = found
    assert stars < 2 * len(texts) and pairs < len(texts)


@pytest.mark.parametrize("size", [3, 9, 13, 17, 25, 60, 900])
def test_alike_sets_share_a_signature(size):
    """Over many random pairs at the very limit, also of two sizes."""
    rng, like = np.random.default_rng(size), ngram_join.Likeness(5, 80, 100)
    for _ in range(200):
        common = rng.integers(0, 2 ** 63, size, np.uint64)
        for extra in {0, min(1, size // 4), size // 8, size // 4}:
            a = np.unique(np.concatenate([common, rng.integers(0, 2 ** 63, extra, np.uint64)]))
            b = np.unique(np.concatenate([common, rng.integers(0, 2 ** 63, size // 4 - extra, np.uint64)]))
            if len(a) * 100 < 80 * len(b) or len(b) * 100 < 80 * len(a) or set(a) == set(b):
                continue
            assert set(ngram_join.signatures(a, like).tolist()) & set(ngram_join.signatures(b, like).tolist())
            assert ngram_join._differing(ngram_join.sketch(a), ngram_join.sketch(b)) <= size // 4


def test_sentencepiece_against_the_library(spark, docs):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {}
    for r in docs:
        ids = model.encode(r.text or "")
        want[r.doc_id] = (len(ids), sha(",".join(map(str, ids))), sha(model.decode(ids)))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows_of(spark, "op6_sentencepiece")}
    assert got == want


def brute_force_removal(texts, window=35):
    starts = Counter()
    for text in texts.values():
        w = words(text)
        starts.update(tuple(w[j:j + window]) for j in range(len(w) - window + 1))
    out = {}
    for i, text in texts.items():
        w = words(text)
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if starts[tuple(w[j:j + window])] > 1:
                gone[j:j + window] = [True] * window
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out[i] = (len(w), sum(gone), sha(b" ".join(kept)))
    return out


@pytest.mark.parametrize("part_rows", [4096, 2])
def test_substring_dedup_against_brute_force(spark, docs, monkeypatch, part_rows):
    """With parts of two rows most phrases are too long for one and their suffixes go by all their words."""
    monkeypatch.setattr("subpulse.llm.substring_dedup.PART_ROWS", part_rows)
    monkeypatch.setattr("subpulse.llm.substring_dedup.SLICE_WORDS", 2000)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows_of(spark, "op7_substring_dedup")}
    want = brute_force_removal({r.doc_id: r.text for r in docs})
    assert got == want and any(0 < n < m for m, n, _ in want.values())


def test_warc_against_the_pages(spark):
    pages = spark.read.parquet(f"{MEDIUM}/pages.parquet").collect()
    same = defaultdict(list)
    for r in pages:
        same[r.html or ""].append(r.page_id)
    want = set()
    for r in pages:
        payload, largest = (r.html or "").encode(), max(same[r.html or ""])
        want.add((r.page_id, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                  *(("response", None) if r.page_id == largest else ("revisit", largest))))
    assert {tuple(r) for r in rows_of(spark, "op8_warc", MEDIUM)} == want


def test_language_on_held_out_rows(spark):
    rows = {r.doc_id: r for r in rows_of(spark, "op9_language_id", MEDIUM)}
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()
    assert all(rows[r.doc_id].held_out == (crc(r.doc_id, 5) == 0) for r in docs)
    held_out = [rows[r.doc_id].lang_pred == r.lang for r in docs if rows[r.doc_id].held_out]
    assert sum(held_out) >= 0.95 * len(held_out)


PRIVATE = re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+|AKIA[A-Z0-9]{16}|password=\w+|\+1 \(\d+\) \d+-\d+"
                     r"|(?<![\w.])\d+\.\d+\.\d+\.\d+(?!\w)")


def test_surrogates_replace_all_and_only_private_data(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()
    got = {r.doc_id: r for r in rows_of(spark, "op10_pii_surrogates", MEDIUM)}
    seen = defaultdict(set)
    for r in docs:
        old, new = PRIVATE.findall(r.text), PRIVATE.findall(got[r.doc_id].text)
        assert len(old) == len(new) and not set(old) & set(new)
        assert len(got[r.doc_id].text) == len(r.text) or "." in "".join(old)
        for a, b in zip(old, new, strict=True):
            seen[a].add(b)
        if not old and got[r.doc_id].kinds not in ("card", "hex", "card,hex"):
            assert got[r.doc_id].text == r.text and got[r.doc_id].n_entities == 0
    assert all(len(v) == 1 for v in seen.values())
    assert len(set.union(*seen.values())) == len(seen)
