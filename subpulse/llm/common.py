"""What several text operators share: words, row lookups that survive hot keys, and hashing inside tasks."""

from __future__ import annotations

import os
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subpulse.session import settle

#: A word is a run of anything but ASCII white space. ``bytes.split()`` cuts at the same six bytes.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

#: A key that owns more than one row in this many is looked up by broadcast; there are fewer than this many such keys.
HOT_SHARE = 1000

_ONE, _TWO, _THREE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def reach_workers(spark: SparkSession) -> None:
    """Put this package on the path of Python workers that share the driver's files, wherever it was started.

    Other clusters get the package with ``--py-files`` as usual.
    """
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: str | Column) -> Column:
    """Words of a text; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_text(doc_id: str | Column) -> Column:
    return F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"), F.lit(""))


def id_remainder(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a NULL id counts as the empty text."""
    return F.pmod(F.crc32(id_text(doc_id)), F.lit(folds)).cast("int")


def lookup(rows: DataFrame, facts: DataFrame, key: str, total: int, weight: str) -> DataFrame:
    """Inner join of ``rows`` with ``facts``, one row per ``key``, where ``weight`` counts the key's rows.

    Keys with more than a thousandth of all ``total`` rows are fewer than a
    thousand, so they are broadcast; every other key is small enough for one
    partition of a shuffle. No key meets all of its rows in one task.
    """
    hot = F.col(weight) * HOT_SHARE > total
    hot_facts = F.broadcast(facts.filter(hot))
    cold_rows = rows.join(hot_facts.select(key), key, "left_anti")
    return rows.join(hot_facts, key).unionByName(cold_rows.join(facts.filter(~hot), key))


def settle_lean(df: DataFrame, name: str) -> DataFrame:
    """``settle``, after which the shuffle files of the job that wrote the table are removed.

    Steps that follow each other then need the disk of the largest, not of all.
    """
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        return settle(df, name)
    finally:
        conf.set(key, before)


def discard(*settled: DataFrame) -> None:
    """Delete settled tables that nothing reads any more: whatever came from them is settled too."""
    for df in settled:
        context = df.sparkSession.sparkContext
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()[:1]}:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


class WordHashes(dict):
    """word -> 64-bit hash, computed once per distinct word. Emptied when full, so memory stays bounded."""

    def __init__(self, most: int = 300_000, lower: bool = False):
        self.most, self.lower = most, lower

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word.lower() if self.lower else word)
        if len(word) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values."""
    x = x + _ONE
    x = (x ^ (x >> np.uint64(30))) * _TWO
    x = (x ^ (x >> np.uint64(27))) * _THREE
    return x ^ (x >> np.uint64(31))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
