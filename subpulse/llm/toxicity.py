"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (with its ends marked) and itself,
each with an embedding in a hashed table. The embeddings of some words are
averaged, and a linear softmax over the average gives two classes. A misspelling
that was never seen shares most n-grams with the word it comes from.

A text is judged by its worst passages, up to ``WORST`` of them of ``PASSAGE``
words, that do not overlap: their words together are the bag. So insults in a text
of twenty thousand words are not averaged away. Labels stand for whole texts, so
training first takes passages from everywhere by the text's label and then, again
and again, the worst ones found so far.

One passage alone must be worse than several together are on average, as in a long
text a harmless word looks bad by chance. What one, two or more must exceed to score
``MARK`` is set on the training texts: ``CLEAN_SHARE`` of those without the label do
at most, and where the two classes lie apart the mark is half way between them.

The softmax of an average is linear in the n-grams. So scoring needs two numbers a
word, a sum and a count, and running sums over the text, and models of several
seeds are averaged into one that costs no more.

The sample that teaches is bounded: ``ROWS_PER_CLASS`` labelled rows a class. A
text longer than ``EXCERPTS`` blocks of ``BLOCK`` characters is represented by so
many of its blocks, chosen by hash over its whole length; rows are never left out
for their length.

Defined results: a NULL text or one without words scores 0; with no toxic or no
other training rows every score is the share of toxic ones (0 without rows);
repeated rows and NULL ids are rows like any others. An empty table gives no
rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subpulse.llm.common import id_text, mix64

PASSAGE, WORST = 2, 4
#: The share of the training texts without the label whose worst passages, of each number, score above the mark.
CLEAN_SHARE, MARK = 0.003, 0.3
#: The share of toxic training texts that may lie below the level taken for theirs: some hold nothing toxic.
TOXIC_SHARE = 0.1
GRAMS = (3, 4, 5)
BUCKETS, DIM = 1 << 17, 8
#: The sample that teaches: at most so many labelled rows of each class, of at most so many blocks of so many characters.
ROWS_PER_CLASS, EXCERPTS, BLOCK = {1: 1000, 0: 2500}, 10, 2000
SEEDS = (7, 8, 9)
#: Passages of a text that is not toxic that are learned beside its worst one, in every round.
OTHERS = 1
#: A toxic passage counts as much as so many others: there are fewer of them.
TOXIC_WEIGHT = 9
#: An n-gram is learned if it occurs in at least two texts and one in so many.
ONE_TEXT_IN = 80
#: Words whose evidence a worker keeps before it starts anew.
MOST_KNOWN = 400_000
TRIM = b".,;:!?|\"'()[]"


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams, in characters, of each marked word and of the word itself; and how many a word has.

    All words are hashed together: they stand in one array of code points with
    line ends between them, and n-grams that reach over an end are left out.
    """
    text = b"\n".join([w.strip(TRIM) or w for w in words]).decode("utf-8", "replace").lower()
    codes = np.frombuffer(f"<{text.replace(chr(10), '>' + chr(10) + '<')}>\n".encode("utf-32-le"), np.uint32)
    ends = np.flatnonzero(codes == 10)
    lengths = np.diff(ends, prepend=-1) - 1
    owner = np.repeat(np.arange(len(ends)), lengths + 1)
    place = np.arange(len(codes))
    left = ends[owner] - place  # characters of the word from here on
    spread = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    whole = np.add.reduceat(mix64(spread ^ (place - (ends - lengths)[owner]).astype(np.uint64)), ends - lengths)
    owners, hashes = [np.arange(len(ends))], [whole]
    rolled = mix64(spread)
    for n in range(2, max(GRAMS) + 1):
        rolled = mix64(rolled[:-1] ^ spread[n - 1:])
        if n in GRAMS:
            inside = left[:len(rolled)] >= n
            owners.append(owner[:len(rolled)][inside])
            hashes.append(rolled[inside])
    owners, hashes = np.concatenate(owners), np.concatenate(hashes)
    order = np.argsort(owners, kind="stable")
    return (hashes[order] % np.uint64(BUCKETS)).astype(np.int32), np.bincount(owners, minlength=len(ends))


def words_of(text: bytes) -> list[bytes]:
    """The words of a text; one that goes on repeating itself stands once, so that a passage is never a single word."""
    words = text.split()
    return [w for w, before in zip(words, [None, *words]) if w != before]


@dataclass
class Model:
    """``slope``: what each n-gram bucket adds to the log odds of the toxic class; ``bias``: what these start from, by
    the number of passages."""
    slope: np.ndarray
    bias: np.ndarray
    prior: float | None = None
    #: word -> its evidence, the sum of its n-grams' slopes, and as imaginary part their number
    known: dict[bytes, complex] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def meet(self, texts: list[list[bytes]]) -> None:
        """Learn the evidence of all words in these texts that are not known yet."""
        if len(self.known) > MOST_KNOWN:
            self.known.clear()
        new = list(set().union(*texts).difference(self.known))
        if new:
            ids, counts = subwords(new)
            sums = np.add.reduceat(self.slope[ids].astype(float), np.cumsum(counts) - counts)
            self.known.update(zip(new, (sums + 1j * counts).tolist(), strict=True))

    def scores(self, texts: list[bytes]) -> list[float]:
        if self.prior is not None:
            return [self.prior if text.split() else 0.0 for text in texts]
        split = [words_of(text) for text in texts]
        self.meet(split)
        out = []
        for words in split:
            odds = (self.evidence(words) + self.bias).max() if words else -np.inf
            out.append(0.0 if odds == -np.inf else float(1 / (1 + np.exp(-np.clip(odds, -40, 40)))))
        return out

    def evidence(self, words: list[bytes]) -> np.ndarray:
        """That of a text's worst passages, one, two or more of them. Its words are known."""
        pairs = np.fromiter(map(self.known.__getitem__, words), complex, len(words))
        return worst_passages(pairs.real, pairs.imag)[1]

    def calibrate(self, clean: list[list[bytes]], toxic: list[list[bytes]]) -> None:
        """Set the bias of each number of passages by the texts that were learned from."""
        levels = []
        for texts, place in ((clean, 1 - CLEAN_SHARE), (toxic, TOXIC_SHARE)):
            self.meet(texts)
            levels.append(np.quantile([self.evidence(words) for words in texts], place, axis=0, method="higher") + 1e-6)
        self.bias = np.log(MARK / (1 - MARK)) - np.maximum(levels[0], (levels[0] + levels[1]) / 2)


def worst_passages(evidence: np.ndarray, counts: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Where a text's worst passages start, and the evidence of the first, the first two ... together, per n-gram.

    A text shorter than a passage is one passage, and where there are no more the last number stands for all.
    """
    width = min(PASSAGE, len(evidence))
    totals = np.zeros((2, len(evidence) + 1))
    np.cumsum(evidence, out=totals[0, 1:])
    np.cumsum(counts, out=totals[1, 1:])
    sums, sizes = totals[:, width:] - totals[:, :-width]
    means, starts = sums / sizes, []
    for _ in range(WORST):
        at = int(means.argmax())
        if means[at] == -np.inf:
            break
        starts.append(at)
        means[max(at - width + 1, 0):at + width] = -np.inf
    together = np.cumsum(sums[starts]) / np.cumsum(sizes[starts])
    return starts, np.concatenate([together, np.full(WORST - len(starts), together[-1])])


@dataclass
class Bags:
    """The subwords of a vocabulary, one word after another."""
    ids: np.ndarray
    starts: np.ndarray
    counts: np.ndarray

    @staticmethod
    def of(vocabulary: list[bytes]) -> Bags:
        parts = [subwords(vocabulary[at:at + 20_000]) for at in range(0, len(vocabulary), 20_000)]  # to save memory
        counts = np.concatenate([n for _, n in parts])
        return Bags(np.concatenate([ids for ids, _ in parts]), np.cumsum(counts) - counts, counts)

    def gather(self, words: np.ndarray) -> np.ndarray:
        """The subwords of these words, side by side."""
        counts = self.counts[words]
        ends = np.cumsum(counts)
        return self.ids[np.arange(ends[-1]) + np.repeat(self.starts[words] - (ends - counts), counts)]


@dataclass
class Learner:
    """Embeddings and softmax while they are learned, with Adagrad's squares; rare buckets stay at nothing."""
    table: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    squares: list[np.ndarray]
    frequent: np.ndarray

    @staticmethod
    def start(rng: np.random.Generator, frequent: np.ndarray) -> Learner:
        parts = [rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32) * frequent[:, None],
                 rng.normal(0, 0.1, (DIM, 2)).astype(np.float32), np.zeros(2, np.float32)]
        return Learner(*parts, [np.zeros_like(x) for x in parts], frequent)

    def slope(self) -> np.ndarray:
        return self.table @ (self.weights[:, 1] - self.weights[:, 0])

    def step(self, ids: np.ndarray, counts: np.ndarray, labels: np.ndarray, rate: float) -> None:
        """One Adagrad step on the softmax loss, through the average into the embeddings."""
        hidden = np.add.reduceat(self.table[ids], np.cumsum(counts) - counts) / counts[:, None]
        logits = hidden @ self.weights + self.bias
        error = np.exp(logits - logits.max(1, keepdims=True))
        error /= error.sum(1, keepdims=True)
        error[np.arange(len(labels)), labels] -= 1
        error *= np.where(labels, TOXIC_WEIGHT, 1)[:, None] / len(labels)
        to_table = (error @ self.weights.T) / counts[:, None]
        order = np.argsort(ids, kind="stable")
        touched, first = np.unique(ids[order], return_index=True)
        gradient = np.add.reduceat(np.repeat(to_table, counts, axis=0)[order], first) * self.frequent[touched, None]
        for value, change, seen, at in ((self.table, gradient, self.squares[0], touched),
                                        (self.weights, hidden.T @ error, self.squares[1], slice(None)),
                                        (self.bias, error.sum(0), self.squares[2], slice(None))):
            seen[at] += change ** 2
            value[at] -= rate * change / np.sqrt(seen[at] + 1e-10)


def _frequent(texts: list[np.ndarray], bags: Bags) -> np.ndarray:
    """Which buckets occur in enough texts to be learned; what a text or two have would be learned by heart."""
    n = np.zeros(BUCKETS, int)
    for words in texts:
        n[np.unique(bags.gather(np.unique(words)))] += 1
    return (n >= max(2, len(texts) // ONE_TEXT_IN)).astype(np.float32)


def _learn(texts: list[np.ndarray], bags: Bags, labels: np.ndarray, frequent: np.ndarray, rounds: int, rate: float,
           seed: int) -> Learner:
    rng = np.random.default_rng(seed)
    learner = Learner.start(rng, frequent)
    for turn in range(rounds):
        evidence = np.add.reduceat(learner.slope()[bags.ids], bags.starts)
        chosen: list[tuple[int, list[int]]] = []
        for i, words in enumerate(texts):
            last = max(len(words) - PASSAGE, 0)
            some = [[int(at) for at in rng.integers(0, last + 1, WORST)] for _ in range(
                min(last // (PASSAGE * WORST) + 1, 12) if turn == 0 else OTHERS * (1 - labels[i]))]
            if turn:
                some.append(worst_passages(evidence[words], bags.counts[words])[0])
            chosen += [(i, starts) for starts in some]
        for part in np.array_split(rng.permutation(len(chosen)), max(1, len(chosen) // 256)):
            bag = [np.concatenate([texts[i][at:at + PASSAGE] for at in starts]) for i, starts in (chosen[k] for k in part)]
            counts = np.array([bags.counts[words].sum() for words in bag])
            learner.step(bags.gather(np.concatenate(bag)), counts, labels[[chosen[k][0] for k in part]], rate)
    return learner


def train(rows: list[tuple[str, int]], rounds: int = 8, rate: float = 0.3, seeds: tuple[int, ...] = SEEDS) -> Model:
    """The model of (text, label) rows; the same rows in the same order give the same model."""
    rows = [(words_of(text.encode()), label) for text, label in rows if text and text.split()]
    labels = np.array([label for _, label in rows], int)
    if not rows or labels.min() == labels.max():
        return Model(np.zeros(0), np.zeros(WORST), float(labels.mean()) if rows else 0.0)
    places: dict[bytes, int] = {}
    texts = [np.array([places.setdefault(w, len(places)) for w in words]) for words, _ in rows]
    bags = Bags.of(list(places))
    frequent = _frequent(texts, bags)
    learners = [_learn(texts, bags, labels, frequent, rounds, rate, seed) for seed in seeds]
    model = Model(np.mean([x.slope() for x in learners], axis=0).astype(np.float32), np.zeros(WORST))
    model.calibrate(*[[words for words, its in rows if its == label] for label in (0, 1)])
    return model


def excerpt(text: str) -> Column:
    """A text of at most ``EXCERPTS`` blocks, or so many of its blocks, chosen by hash, in order."""
    blocks = F.sequence(F.lit(0), F.floor((F.length(text) - 1) / BLOCK).cast("int"))
    chosen = F.slice(F.array_sort(F.transform(blocks, lambda k: F.struct(F.xxhash64(F.lit("block"), k).alias("place"),
                                                                         k.alias("k")))), 1, EXCERPTS)
    picked = F.transform(F.array_sort(F.transform(chosen, lambda c: c["k"])), lambda k: F.substring(F.col(text), k * BLOCK + 1, F.lit(BLOCK)))
    return F.when(F.length(text) <= EXCERPTS * BLOCK, F.col(text)).otherwise(F.array_join(picked, " "))


def training_rows(documents: DataFrame, labels: DataFrame,
                  rows_per_class: dict[int, int] | None = None) -> list[tuple[str, int]]:
    """The bounded sample: of each class, the labelled rows that come first by the hash of their ids."""
    place = F.xxhash64(id_text("doc_id"), F.lit("toxicity"))
    rows = []
    for label, most in (rows_per_class or ROWS_PER_CLASS).items():
        picked = (labels.filter(F.col("toxic") == label).select("doc_id").distinct()
                  .orderBy(place, "doc_id").limit(2 * most))  # twice, as some have no text
        found = (documents.filter(F.length("text") > 0).select("doc_id", excerpt("text").alias("text"))
                 .join(F.broadcast(picked), "doc_id").orderBy(place, "doc_id", "text").limit(most))
        rows += [(r.text, label) for r in found.select("text").collect()]
    return rows


def scorer(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """A column function: the score of a whole text."""
    shared = spark.sparkContext.broadcast(model)  # a table of fixed size

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = shared.value
        for batch in batches:
            texts = [text or b"" for text in batch]
            found = [known.scores(texts[at:at + 64]) for at in range(0, len(texts), 64)]  # few, as texts may be long
            yield pd.Series([score for part in found for score in part], dtype=float)

    return lambda text: run(text.cast("binary"))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, score. Reads ids and whole texts only."""
    score_of = scorer(documents.sparkSession, model)
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), score_of(F.col("text")).alias("score"))
