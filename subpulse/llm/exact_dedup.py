"""Exact deduplication by tree-merging sorted digest runs.

Every partition holds a run: its digests in order, each once, with the smallest
(id, row) it has seen and a count. The runs then meet in binomial rounds. With
P = f**R runs, round r sends each entry to the partition that agrees with its
digest's bucket in the first r base-f digits and with its present place in the
others: f partitions exchange shares of their runs, and each merges f of them.
After R rounds a bucket's entries are in one partition, one per digest, and no
round holds more than a P-th of the digests in one place. Copies vanish at the
first level, so a text that a third of all rows carry is one entry per run.

Entries merge only if digest, length in bytes and a second hash agree.

Defined results: NULL texts count as empty, empty texts are equal to each other
and texts of white space only equal one space. NULL ids come after all others.
Rows that repeat both id and text are documents of their own: exactly one of
them stays. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subpulse.llm.common import GAP, lookup
from subpulse.session import settle

RUN = "digest binary, n_bytes long, proof long, keep_id long, keep_row long, group_size long, place long"
KEY = ("digest", "n_bytes", "proof")


def normalised() -> Column:
    return F.regexp_replace(F.coalesce("text", F.lit("")), GAP, " ")


def key_of(text: str) -> list[Column]:
    """The key of a normalised text, as in ``KEY``."""
    return [F.unhex(F.sha2(text, 256)).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"),
            F.xxhash64(text).alias("proof")]


def digests(documents: DataFrame) -> DataFrame:
    """(doc_id, row, digest, n_bytes, proof) of each row's normalised text, settled so that row numbers stay."""
    return settle(documents.select("doc_id", normalised().alias("t")).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), *key_of("t")),
        "digests")


def _merge_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries in order of (key, id, row): equal keys become one, the first, with the sum of their counts."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = pa.RecordBatch.from_arrays(batch.columns, names=batch.schema.names)  # every column may be NULL
        rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        new = np.ones(rows.num_rows, bool)
        if rows.num_rows > 1:
            same = [pc.equal(rows[c].slice(1), rows[c].slice(0, rows.num_rows - 1)) for c in KEY]
            new[1:] = ~np.asarray(pc.and_(pc.and_(same[0], same[1]), same[2]))
        first = np.flatnonzero(new)
        sums = np.add.reduceat(rows["group_size"].to_numpy(), first)
        rows = rows.take(first).set_column(rows.schema.get_field_index("group_size"), "group_size", pa.array(sums))
        *done, held = rows.slice(0, rows.num_rows - 1).to_batches() + rows.slice(rows.num_rows - 1).to_batches()
        yield from done
    if held is not None:
        yield held


def _merged(entries: DataFrame) -> DataFrame:
    order = [*KEY, F.col("keep_id").asc_nulls_last(), "keep_row"]
    return entries.sortWithinPartitions(*order).mapInArrow(_merge_sorted, RUN)


def merge_runs(entries: DataFrame, width: int) -> DataFrame:
    """One entry per key from entries in any order; ``width`` is the least number of partitions to end in."""
    rounds = max(2, ceil(log(max(width, 2), 16)))
    fan_in = max(2, ceil(width ** (1 / rounds)))
    places = fan_in ** rounds
    runs = _merged(entries.withColumn("place", F.pmod(F.spark_partition_id(), F.lit(places)).cast("long")))
    bucket = F.pmod(F.xxhash64(*KEY), F.lit(places))
    for r in range(1, rounds + 1):
        kept = fan_in ** (rounds - r)  # the lower digits of a place, which this round leaves alone
        place = bucket - bucket % kept + F.col("place") % kept
        runs = _merged(runs.withColumn("place", place).repartitionById(places, F.col("place").cast("int")))
    return runs


def exact_groups(found: DataFrame) -> DataFrame:
    """The settled table of distinct texts of ``digests()``: key, keep_id, keep_row, group_size."""
    spark = found.sparkSession
    entries = found.select(*KEY, F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"),
                           F.lit(1).cast("long").alias("group_size"))
    return settle(merge_runs(entries, int(spark.conf.get("spark.sql.shuffle.partitions"))), "digest-groups")


def dedup(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    found = digests(documents)
    key = F.struct(*KEY).alias("key")
    groups = exact_groups(found).select(key, "keep_id", "keep_row", "group_size")
    return lookup(found.select("doc_id", "row", key), groups, "key", found.count(), "group_size").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("key.digest")).alias("text_sha256"))


def keep_first(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that stay, with all their columns.

    They are met by text and id, so copies with other ids go before a join has
    many rows of one key. Rows that repeat both are told apart by nothing; of
    those, which are known by their count, any one stays.
    """
    found = digests(documents)
    repeated = found.groupBy(*KEY, "doc_id").count().filter("count > 1").select(
        F.struct(*KEY).alias("_again"), F.col("doc_id").alias("_id"))
    first = exact_groups(found).select(F.struct(*KEY).alias("_of"), "keep_id")
    facts = settle(first.join(repeated, (F.col("_again") == F.col("_of")) & F.col("_id").eqNullSafe(F.col("keep_id")),
                              "left").select("_of", "keep_id", F.col("_again").isNotNull().alias("repeated")), "stays")
    rows = documents.select(F.struct("*").alias("_row"), normalised().alias("_text")).select(
        "_row", F.struct(*key_of("_text")).alias("_key"))
    kept = rows.join(facts, (F.col("_key") == F.col("_of"))
                     & F.col("_row.doc_id").cast("long").eqNullSafe(F.col("keep_id")))
    once = kept.filter("repeated").groupBy("_key", "keep_id").agg(F.first("_row").alias("_row"))
    return kept.filter("NOT repeated").select("_row").unionByName(once.select("_row")).select("_row.*")
