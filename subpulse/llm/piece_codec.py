"""SentencePiece encoding and decoding of merge-type (BPE) models, exact, by backtracking.

A text is encoded from the left with the longest piece that fits, found by an
Aho-Corasick automaton. A piece may follow another only if re-merging the text
of both gives these two again; if no piece fits, the last one is taken back for
a shorter one, and a bit marks the position as failed so that it is never tried
again. A chain in which every neighbouring pair survives re-merging is the
merge encoding, and the encoding of a prefix is unique, so a failed position
stays failed and the search is linear.

Neighbouring characters that no piece holds side by side always end up in
different pieces. Texts are cut there, before a space mark above all, and the
encodings of the cut parts are kept in bounded caches.

Defined results: a NULL text counts as empty, and an empty text has no ids and
decodes to the empty text. Characters that no piece covers become their UTF-8
bytes. Repeated rows and NULL ids are kept as they are. Extra columns are
ignored. Models whose normaliser changes texts are refused.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
ENCODED = "doc_id long, ids array<int>, decoded string"


class _Bounded(dict):
    """A dict that computes what is missing and empties itself when full."""

    def __init__(self, compute: Callable, most: int, longest: int = 64):
        self.compute, self.most, self.longest = compute, most, longest

    def __missing__(self, key):
        value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


class PieceCodec:
    def __init__(self, model_path: str, cache_size: int = 400_000):
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        probe = "a  ﬁÅＡ b\t "
        if model.normalize(probe).replace(" ", MARK) != MARK + probe.replace(" ", MARK):
            raise ValueError("the model's normaliser changes texts")
        ids = range(model.vocab_size())
        plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        if any(model.is_unused(i) for i in plain):
            raise ValueError("the model has unused pieces")
        self.ids = {model.id_to_piece(i): i for i in plain}
        self.score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        self.bytes_of = {int(model.id_to_piece(i)[3:5], 16): i for i in ids if model.is_byte(i)}
        self.unknown = model.unk_id()
        self.surface = [b"" if model.is_control(i) else model.id_to_piece(i).replace(MARK, " ").encode() for i in ids]
        for value, i in self.bytes_of.items():
            self.surface[i] = bytes([value])
        self.surface[self.unknown] = " ⁇ ".encode()
        self.neighbours = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.runs = re.compile(r"▁*[^\W\d_]+|\n|[\W\d_]").findall
        known = {*self.ids, *(c for p in self.ids for c in p)}
        # the next shorter piece that a piece begins with
        self.shorter = {p: next((n for n in range(len(p) - 1, 0, -1) if p[:n] in known), 0) for p in known}
        self.automaton = ahocorasick.Automaton()
        for piece in known:
            self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        self.cuts_at_mark = not any(x[1] == MARK and x[0] != MARK for x in self.neighbours)
        self.fits = _Bounded(self._fits, 400_000)
        self.parts = _Bounded(self._part, cache_size)
        self.words = _Bounded(lambda word: self._ids_as_bytes(MARK + word), cache_size)

    def remerge(self, text: str) -> list[str]:
        """Merging by score, the leftmost of equals first, from single characters."""
        parts = list(text)
        while len(parts) > 1:
            scores = [self.score.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
            known = [s for s in scores if s is not None]
            if not known:
                break
            at = scores.index(max(known))
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fits(self, pair: tuple[str, str]) -> bool:
        """May the second piece follow the first? ("", piece) asks whether merging ever makes the piece."""
        return self.remerge(pair[0] + pair[1]) == [x for x in pair if x]

    def _pieces(self, text: str) -> list[str]:
        """Backtracking over one part."""
        longest = [1] * len(text)  # a character that no piece holds stands alone
        for end, length in self.automaton.iter(text):  # matches that end later are longer
            longest[end - length + 1] = length
        failed, fits, shorter = bytearray(len(text) + 1), self.fits, self.shorter
        pieces, at, previous, length = [], 0, "", longest[0]
        while at < len(text):
            while length:
                piece = text[at:at + length]
                if not failed[at + length] and fits[previous, piece]:
                    break
                length = shorter.get(piece, 0)
            else:  # nothing fits here: take the last piece back
                failed[at] = 1
                piece = pieces.pop()
                at, length = at - len(piece), shorter.get(piece, 0)
                previous = pieces[-1] if pieces else ""
                continue
            pieces.append(piece)
            at, previous = at + length, piece
            length = longest[at] if at < len(text) else 0
        return pieces

    def _part(self, text: str) -> bytes:
        out: list[int] = []
        for piece in self._pieces(text):
            if piece in self.ids:
                out.append(self.ids[piece])
            elif self.bytes_of:
                out += [self.bytes_of[b] for b in piece.encode()]
            else:
                out.append(self.unknown)
        return np.array(out, np.int32).tobytes()

    def _ids_as_bytes(self, text: str) -> bytes:
        """Cut where letters meet other characters, if no piece holds the two side by side."""
        runs = self.runs(text)
        if len(runs) == 1:
            return self.parts[text]
        parts = [runs[0]]
        for run in runs[1:]:
            if parts[-1][-1] + run[0] in self.neighbours:
                parts[-1] += run
            else:
                parts.append(run)
        return b"".join([self.parts[x] for x in parts])

    def encode_to_bytes(self, text: str) -> bytes:
        """The ids as little-endian 32-bit integers."""
        if not text:
            return b""
        words = text.split(" ")
        if self.cuts_at_mark and MARK not in text and all(words):
            return b"".join(map(self.words.__getitem__, words))  # each word with the mark before it
        marked = MARK + text.replace(" ", MARK)
        if not self.cuts_at_mark:
            return self._ids_as_bytes(marked)
        return b"".join([self.words[x[1:]] if x[0] == MARK and len(x) > 1 and x[1] != MARK else self._ids_as_bytes(x)
                         for x in re.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", marked)])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_to_bytes(text), "<i4").tolist()

    def decode(self, ids: list[int]) -> str:
        """Pieces side by side, marks as spaces, without the space of the first piece; bad bytes as U+FFFD."""
        raw = b"".join(map(self.surface.__getitem__, ids))
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = "".join(self._decode_each(raw))
        return text[1:] if ids and ids[0] not in self.bytes_of.values() and text[:1] == " " and (
            ids[0] != self.unknown) else text

    @staticmethod
    def _decode_each(raw: bytes) -> Iterator[str]:
        at = 0
        while at < len(raw):
            for length in (1, 2, 3, 4):
                try:
                    yield raw[at:at + length].decode()
                    at += length
                    break
                except UnicodeDecodeError:
                    continue
            else:
                yield "�"
                at += 1


@cache
def codec(model_path: str) -> PieceCodec:
    """One codec per Python worker and model."""
    return PieceCodec(model_path)


def round_trip(documents: DataFrame, model_path: str) -> DataFrame:
    """One row per document: doc_id, ids, and what the ids decode to."""
    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = codec(model_path)
        for batch in batches:
            for part in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):  # small batches of long rows
                raw = [pieces.encode_to_bytes(text.as_py()) for text in part.column("text")]
                ends = np.cumsum([0, *(len(x) // 4 for x in raw)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(raw), "<i4")))
                decoded = [pieces.decode(np.frombuffer(x, "<i4").tolist()) for x in raw]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids, pa.array(decoded, pa.string())],
                                                 ["doc_id", "ids", "decoded"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.coalesce("text", F.lit("")).alias("text")).mapInArrow(convert, ENCODED)


def digested(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text."""
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
