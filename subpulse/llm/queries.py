"""Registered queries of the text operators: (spark, sf_dir) -> DataFrame over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subpulse.llm import (decontamination, exact_dedup, importance, language_id, merkle, mixing, ngram_join, pii_surrogates,
                          piece_codec, quality_cascade, substring_dedup, toxicity, warc)
from subpulse.llm.common import id_remainder, table

#: Score from which a document counts as toxic, and the folds held out from learning.
TOXIC_FROM = 0.3
TOXIC_FOLDS, TOXIC_HELD_OUT = 4, 2
LANG_FOLDS, LANG_HELD_OUT = 5, 0
#: The key of the registered query; who uses the operator passes a secret of their own.
SURROGATE_KEY = "example"
THREE_WORDS_90 = ngram_join.Likeness(words=3, least=90, of=100)
PIECES = "piece_bpe_32k.model"
#: Every third row of the manifest is held against its proof with A-Z of its text in lower case.
TAMPERED_ONE_IN = 3


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def toxicity_model(documents: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Learned from the rows that are not held out."""
    learned = id_remainder("doc_id", TOXIC_FOLDS) != TOXIC_HELD_OUT
    return toxicity.train(toxicity.training_rows(documents, labels.filter(learned)))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = id_remainder("doc_id", TOXIC_FOLDS) == TOXIC_HELD_OUT
    return toxicity.score(documents, toxicity_model(documents, labels)).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.near_duplicates(table(spark, sf_dir, "documents"), THREE_WORDS_90)
    return found.select("doc_id", "n_shingles", "component_id")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cascade.quality(table(spark, sf_dir, "documents")).drop("rejected_by")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = piece_codec.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))
    return piece_codec.digested(encoded)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=35).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive_folder(spark)
    archives = warc.write_archives(warc.with_revisits(table(spark, sf_dir, "pages"), least_bytes=0), folder)
    return warc.read_archives(archives, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", LANG_FOLDS) == LANG_HELD_OUT
    dictionaries = language_id.learn_dictionaries(documents.filter(~held_out))
    return language_id.identify(documents, dictionaries).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_surrogates.replace_pii(table(spark, sf_dir, "documents"), SURROGATE_KEY)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                                importance.Features(least=1, most=1, buckets=10_000), percent=10, least_words=20, seed=2024)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id", "n_words", decontamination.n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lower = F.translate("text", decontamination.UPPER, decontamination.LOWER)
    tampered = F.when(id_remainder("doc_id", TAMPERED_ONE_IN) == 0, merkle.leaf_digest(text=lower))
    rows = merkle.manifest(table(spark, sf_dir, "documents"), tampered).withColumn(
        "folded", merkle.folded(F.coalesce("claimed", "leaf")))
    return rows.select(
        "doc_id", *[merkle.hexed(c).alias(c) for c in ("leaf", "subroot", "root")],
        merkle.hexed(merkle.proof_digest()).alias("proof_sha256"), merkle.hexed("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"))


QUERIES = {f.__name__: f for f in (
    op1_mix_sources, op2_toxicity, op3_ngram_jaccard, op4_exact_dedup, op5_quality_rules, op6_sentencepiece,
    op7_substring_dedup, op8_warc, op9_language_id, op10_pii_surrogates, op11_importance_resampling, op12_decontamination,
    op13_merkle_manifest)}
