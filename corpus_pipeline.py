"""The corpus pipeline: from documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
keep the columns of ``documents``. Every stage works on all rows that its
predecessor kept, written as Parquet in between.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subpulse.llm import exact_dedup, mixing, ngram_join, piece_codec, toxicity
from subpulse.llm.common import reach_workers, table
from subpulse.llm.queries import PIECES, TOXIC_FROM, toxicity_model
from subpulse.session import settle

#: Near duplicates share four fifths of their five-word shingles.
NEAR = ngram_join.Likeness(words=5, least=80, of=100)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC_FROM``. NULL, empty and wordless texts score 0 and stay; equal texts go or
    stay together, with any id; without labelled rows all stay.
    """
    score_of = toxicity.scorer(spark, toxicity_model(docs, table(spark, sf_dir, "labels")))
    return docs.filter(score_of(F.col("text")) < TOXIC_FROM)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, the row with the smallest id. NULL and empty texts are one such
    text; NULL ids come last; of rows that repeat id and text one stays.
    """
    return exact_dedup.keep_first(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the row with the smallest id; NULL ids come last. Texts without words are
    alike to nothing and stay. Rows that repeat both id and text stay or go together.
    """
    return ngram_join.keep_one(docs, NEAR)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them: not at all, once or twice. NULL is a source of its own, the last; rows of
    one id are taken alike; texts without words are taken as often as their place says, at no cost.
    """
    return mixing.mixed(docs)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number and digest of the token ids, digest of the decoded text, a row per row; NULL counts as empty."""
    return piece_codec.digested(piece_codec.round_trip(docs, public_tokenizers.path(PIECES)))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("n-gram Jaccard join", without_near_copies),
    ("mixing sources to target weights", mixed_sources),
    ("SentencePiece encoding and decoding", tokenised),
]

#: SQL expresses neither the scores nor the token ids; tests hold every stage against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    reach_workers(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
