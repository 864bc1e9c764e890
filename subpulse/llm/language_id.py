"""Language identification by compression.

For each language a bounded sample of labelled excerpts becomes a zstandard
raw-content dictionary. A text is reduced to its letters and cut into blocks, every
block is compressed with every dictionary, and the language whose dictionary gives the smallest
total wins. The margin to the runner-up decides whether the answer is trusted:
below ``narrow`` it is marked as rejected.

Defined results: texts that are NULL or have no letter are ``und`` with score 0,
as is everything if nothing was learned; equal totals go to the language that
comes first by code point; NULL languages teach nothing; repeated rows and NULL
ids are rows like any others. An empty table gives no rows. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subpulse.llm.common import id_text
from subpulse.session import settle

#: The sample that teaches a language: at most this many excerpts of at most this many characters each.
EXCERPTS, EXCERPT_CHARS = 400, 280
BLOCK_BYTES, LEVEL = 2048, 7
#: Bytes of difference that make one language e times as likely as another.
BYTES_PER_E = 8.0
NARROW = 0.004
PREDICTED = "doc_id long, lang_pred string, score double, margin double, rejected boolean"


def letters(text: str) -> Column:
    """The text in lower case, with one space for whatever stands between letters."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")


def learn_dictionaries(labelled: DataFrame, excerpts: int = EXCERPTS, chars: int = EXCERPT_CHARS) -> dict[str, bytes]:
    """lang -> dictionary, from the excerpts of the rows that come first by the hash of id and text.

    Languages are counted first. A share of each, by hash, that leaves about four
    times the excerpts needed goes on, so no task sees more than that of a
    language, however many rows it has.
    """
    place = F.xxhash64(id_text("doc_id"), F.lit("language"), "text")
    counts = labelled.filter("lang IS NOT NULL").groupBy(F.col("lang").alias("of")).agg(F.count(F.lit(1)).alias("rows"))
    among = F.pmod("place", F.lit(1 << 40)) * F.col("rows").cast("double") < float(4 * excerpts * (1 << 40))
    start = F.pmod("place", F.greatest(F.length("text") - chars, F.lit(0)) + 1).cast("int") + 1
    few = (labelled.select("lang", "text", place.alias("place"))
           .join(settle(counts, "languages"), F.col("lang") == F.col("of")).filter(among).drop("rows", "of")
           .filter("length(text) > 0").withColumn("text", letters("text")))
    picked = (few.select("lang", "place", F.substring(F.col("text"), start, F.lit(chars)).alias("excerpt"))
              .withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("place", "excerpt")))
              .filter(F.col("n") <= excerpts).orderBy("lang", "n").collect())
    return {lang: "\n".join(r.excerpt for r in picked if r.lang == lang).encode()
            for lang in sorted({r.lang for r in picked})}


@lru_cache(maxsize=4)
def _compressors(dictionaries: tuple[bytes, ...]) -> list[zstandard.ZstdCompressor]:
    made = []
    for content in dictionaries:
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=LEVEL)
        made.append(zstandard.ZstdCompressor(dict_data=known, write_content_size=False))
    return made


def compressed_sizes(text: bytes, compressors: list[zstandard.ZstdCompressor]) -> list[int]:
    blocks = [text[at:at + BLOCK_BYTES] for at in range(0, len(text), BLOCK_BYTES)]
    return [sum(len(c.compress(block)) for block in blocks) for c in compressors]


def identify(documents: DataFrame, dictionaries: dict[str, bytes], narrow: float = NARROW) -> DataFrame:
    """One row per document: doc_id, lang_pred, score, margin, rejected. Reads ids and texts only."""
    langs, contents = tuple(dictionaries), tuple(dictionaries.values())

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compressors = _compressors(contents)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                if not text or not text.strip() or not langs:
                    rows.append(("und", 0.0, 0.0, True))
                    continue
                sizes = np.array(compressed_sizes(text.encode(), compressors), float)
                best = int(sizes.argmin())
                more = np.sort(sizes)
                margin = (more[1] - more[0]) / more[0] if len(more) > 1 else 1.0
                score = 1 / np.exp(np.maximum((more[0] - sizes) / BYTES_PER_E, -700)).sum()
                rows.append((langs[best], score, margin, bool(margin < narrow)))
            out = pd.DataFrame(rows, columns=["lang_pred", "score", "margin", "rejected"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), letters("text").alias("text")).mapInPandas(
        predict, PREDICTED)
