"""Mixing sources to target weights: which documents, and how often, make up the mix.

Every document has a fixed place on a line, a keyed 60-bit hash of its id. A
source's budget is met by taking all of its documents a whole number of times
and, for what is left, those whose place lies below a threshold. The threshold
comes from histograms of words over hash buckets: the first level covers all
documents, and each further level only the bucket in which the budget ends.
Nothing is sorted, and the levels hold at most 4,096 buckets a source.

Defined results: NULL or empty texts have size 0 and add nothing, NULL sources
form one source that comes last, NULL ids share the place of the empty text,
rows that repeat an id share one place and are taken or left together, and an
empty table gives an empty mix. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subpulse.llm.common import id_text, n_words
from subpulse.session import settle

HASH_DIGITS, LEVELS = 15, (12, 12, 12, 12, 12)


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """``sizes`` (source, source_size), one row per source, with ``target``.

    Sources by code point, NULL last, take the weights in turn and share
    ``share`` times all words; a target stops at ``most`` times its source. With
    sources in the order in which they fill up, the full ones are a prefix, so
    the resharing needs one pass: a source is full if it would be with all
    earlier ones full.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    full = F.col("cap") * F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)) <= (
        F.col("weight") * (F.col("budget") - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))))
    left = F.col("budget") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(everything)
    open_weight = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everything)
    return (sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
            .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
            .withColumn("full", full)
            .withColumn("target", F.when(F.col("full"), F.col("cap"))
                        .otherwise(F.col("weight") * F.try_divide(left, open_weight)))
            .select("source", "source_size", "target"))


def _refine(places: DataFrame, state: DataFrame, done: int, bits: int) -> DataFrame:
    """One level: the bucket of ``bits`` more bits in which each source's budget ends."""
    rest = sum(LEVELS) - done
    inside = places.withColumnRenamed("source", "of").join(
        state, F.col("of").eqNullSafe(F.col("source")) & (F.shiftright("place", rest) == F.col("prefix")))
    bucket = F.shiftright("place", rest - bits)
    by_bucket = Window.partitionBy("source").orderBy("bucket")
    histogram = (inside.filter("left > 0").groupBy("source", "left", bucket.alias("bucket"))
                 .agg(F.sum("size").alias("words")).withColumn("upto", F.sum("words").over(by_bucket)))
    return (histogram.filter((F.col("upto") >= F.col("left")) & (F.col("upto") - F.col("words") < F.col("left")))
            .select("source", F.col("bucket").alias("prefix"),
                    (F.col("left") - (F.col("upto") - F.col("words"))).alias("left"),
                    F.col("words").alias("at_words")))


def place_of(seed: str) -> Column:
    """A document's place: the digest of the salted id spreads ids evenly, and any engine can recompute it."""
    digest = F.md5(F.concat(F.lit(seed + ":"), id_text("doc_id")))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("long")


def mix_plan(places: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """One row per source (``of``): source_size, target, and ``whole``, ``threshold``, ``with_last`` for ``copies_of``."""
    sizes = places.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("int")
    plan = settle(source_targets(sizes, weights, share, most).withColumn("whole", whole), "mix-plan")
    state = plan.select("source", F.lit(0).cast("long").alias("prefix"),
                        (F.col("target") - F.col("whole") * F.col("source_size")).alias("left"))
    done = 0
    for bits in LEVELS:
        state, done = settle(_refine(places, state, done, bits), "mix-level"), done + bits
    # the document on which a budget ends is taken if that comes nearer to it
    ends = state.select(F.col("source").alias("ending"), F.col("prefix").alias("threshold"),
                        (F.col("left") * 2 >= F.col("at_words")).alias("with_last"))
    return settle(plan.join(ends, F.col("ending").eqNullSafe(F.col("source")), "left").drop("ending")
                  .withColumnRenamed("source", "of"), "mix-facts")


def copies_of(place: Column) -> Column:
    """How often the mix takes a document at ``place``, given its source's row of the plan."""
    once_more = F.coalesce((place < F.col("threshold")) | ((place == F.col("threshold")) & F.col("with_last")),
                           F.lit(False))
    return F.col("whole") + once_more.cast("int")


def mix(documents: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: int = 2,
        seed: str = "mix") -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    ``copies`` is how often the mix takes the document, ``taken`` = copies x size.
    """
    places = settle(documents.select("doc_id", "source", n_words("text").alias("size"), place_of(seed).alias("place")),
                    "mix-places")
    plan = mix_plan(places, weights, share, most)
    copies = copies_of(F.col("place"))
    return places.join(plan, F.col("of").eqNullSafe(F.col("source"))).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"))


def mixed(documents: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: int = 2,
          seed: str = "mix") -> DataFrame:
    """The mix itself: the rows of ``documents``, each as often as it is taken. Texts are not shuffled."""
    places = settle(documents.select("source", n_words("text").alias("size"), place_of(seed).alias("place")),
                    "mix-places")
    plan = mix_plan(places, weights, share, most).select(
        F.struct("of", "whole", "threshold", "with_last").alias("_plan"))
    rows = documents.select(F.struct("*").alias("_row"), F.col("source").alias("_source"), place_of(seed).alias("_place"))
    taken = rows.join(plan, F.col("_plan.of").eqNullSafe(F.col("_source"))).select("_row", "_place", "_plan.*")
    return taken.select("_row", F.explode(F.array_repeat(F.lit(True), copies_of(F.col("_place"))))).select("_row.*")
