import zlib

import pytest
from pyspark.sql import functions as F

from subpulse.llm.common import reach_workers

CLASHING = ("size place target taken copies of whole threshold digest proof row keep_id kept group_size score predicted "
            "node set root first words signature text_key spans ids decoded mention new kinds payload refers_to").split()
LONG = " ".join(f"w{i % 997}x{i}" for i in range(20_000))


@pytest.fixture(autouse=True)
def workers(spark):
    reach_workers(spark)


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing columns."""
    same = "one two three four five six seven eight nine ten " * 6
    rows = [
        (1, same, "en", "a", 10), (2, same, "en", "a", 10), (2, same, "en", "a", 10), (3, None, None, None, None),
        (4, "", "de", None, 0), (5, " \t\n ", "de", "a", 4), (None, same, "en", "b", 1), (None, None, None, None, None),
        (None, "alone without an id", "en", "b", 1), (6, LONG, "en", "b", None), (7, LONG + " end", "en", "c", 3),
        (8, "short", None, "c", 3), (8, "another text with that id", "fr", "c", 3), (9, "123 456 !!", "fr", "d", 3),
        (10, "x" * 50_000, "en", "d", 3), (11, "Ünïcödé   wörds\n\n▁ mark   end", "de", "d", 3),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("clash") for c in CLASHING})


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)


def words(text):
    return (text or "").encode().split()


def crc(doc_id, folds):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds
