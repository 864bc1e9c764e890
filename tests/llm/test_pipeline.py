"""The corpus pipeline: every stage against brute force on its own input."""

from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from conftest import SMALL

import corpus_pipeline as P
from subpulse.llm import mixing, ngram_join
from tests.llm.conftest import words
from tests.llm.test_queries import brute_force_groups, sha


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows into and out of each stage."""
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for i, (_, stage) in enumerate(P.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(i))
        stage(spark, docs, SMALL).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((docs, after))
        docs = after
    return out


def test_columns_stay(stages):
    assert all(before.columns == after.columns for before, after in stages[:-1])


def test_toxic_documents_go(spark, stages):
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    left = {r.doc_id for r in stages[0][1].collect()}
    assert sum(i not in left for i, t in toxic.items() if t) >= 0.6 * sum(toxic.values())  # learned from eight toxic rows
    assert sum(i in left for i, t in toxic.items() if not t) >= 0.97 * sum(1 - t for t in toxic.values())


def test_one_of_equal_texts_stays(stages):
    before, after = (x.collect() for x in stages[1])
    first = {}
    for r in sorted(before, key=lambda r: r.doc_id):
        first.setdefault(" ".join(w.decode() for w in words(r.text)), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(first.values())


def test_one_of_near_copies_stays(stages):
    before, after = (x.collect() for x in stages[2])
    groups = brute_force_groups({r.doc_id: r.text for r in before}, P.NEAR.words, P.NEAR.least, P.NEAR.of)
    assert sorted(r.doc_id for r in after) == sorted(i for i, (_, c) in groups.items() if i == c)


def test_the_mix_repeats_rows(stages):
    before, after = stages[3]
    copies = {r.doc_id: r.copies for r in mixing.mix(before).collect()}
    assert Counter(r.doc_id for r in after.collect()) == +Counter(copies)


def test_tokens(stages):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(P.PIECES))
    before, after = (x.collect() for x in stages[4])
    want = Counter((r.doc_id, len(ids := model.encode(r.text)), sha(",".join(map(str, ids)))) for r in before)
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in after) == want


def test_run_is_the_stages(spark, stages):
    assert Counter(map(tuple, P.run(spark, SMALL).collect())) == Counter(map(tuple, stages[-1][1].collect()))


def test_stages_on_awkward_rows(spark, awkward, nothing):
    for _, stage in P.STAGES:
        assert stage(spark, awkward, SMALL).count() > 0
        assert stage(spark, nothing, SMALL).count() == 0
    kept = ngram_join.keep_one(awkward)
    assert kept.columns == awkward.columns
    assert Counter(r.doc_id for r in kept.collect())[7] == 0
