"""Substring dedup over sliding spans of pieces.

A text is cut into sentences after . ! ? before whitespace and after newlines; the
whitespace before a piece ends the one before it, so no words run together where
pieces go. Inside a sentence it is cut before every word whose hash with the word
before it is the smallest of some ``WINDOW`` words of the sentence in a row (of
equal hashes closer than that, as in a repeated word, the cuts farthest apart
stay). The places depend on those words only and no piece is longer than
``WINDOW`` words, so whatever stands around a passage, only words at its two ends,
about half of ``WINDOW`` at each, lie in other pieces.

A span is a run of pieces with at least ``MIN_WORDS`` words that touches
``MIN_SENTENCES`` sentences or has more than ``LONG`` words. The shortest that starts
with each piece and the shortest that ends with each are compared by 88 bits of a
hash of their words (A-Z lowered, whitespace as one blank), so a run of equal
pieces is covered from its first to its last. Of each repeated span the first
occurrence (smallest doc_id, then position) stays; pieces covered by any other
occurrence of a repeated span are removed, in the same document too.

One aggregate finds the repeated hashes with their first place (summed up
before the shuffle, so a passage in a third of all documents is one row per
task), one join brings them back to the spans (all spans of a common hash meet
its one row in one task, which streams them), and what has to go is packed per
document. No pairs of documents are formed.

Edge cases: null or empty text has no pieces and becomes ''; rows without id come after
all ids, ordered by the hash of their text; rows equal in id and text count as
one place and are treated alike, so they stay together; an empty table gives
an empty result; extra columns pass through whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pipewright.llm.common import mix, slices

MIN_SENTENCES, MIN_WORDS, LONG = 2, 20, 25
WINDOW = 14  # words: the longest piece
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_WS = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_STOP = np.isin(np.arange(256), list(b".!?"))
_BYTE, _PLACE = np.random.default_rng(20240301).integers(0, 2**64 - 1, (2, 256), dtype=np.uint64) | np.uint64(1)
_ZERO, _TRUE = np.zeros(1, np.int64), np.ones(1, bool)
_BYTE = np.where(_WS, np.uint64(0), _BYTE[np.frombuffer(_LOWER, np.uint8)])


def _join(*parts: np.ndarray) -> np.ndarray:
    return np.concatenate(parts)


class _Text:
    """``raw`` in pieces: ``at`` their first bytes, ``total`` the words before each and in all, ``sent`` the sentence
    of each; ``canon`` the words as compared, ``word`` where each starts in it."""

    def __init__(self, raw: bytes, window: int = WINDOW):
        a = np.frombuffer(raw, np.uint8)
        blank = np.ones(len(a) + 2, np.int8)
        blank[1:-1] = _WS[a]
        edge = blank[1:] - blank[:-1]
        s, e = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        n = len(s)
        self.canon = b" ".join(raw.translate(_LOWER).split())
        self.word = _join(_ZERO, np.cumsum(e - s + 1))
        if not n:
            self.at = self.sent = np.zeros(min(1, len(a)), np.int64)
            self.total = np.zeros(1 + len(self.at), np.int64)
            return
        lines = _join(_ZERO - 1, np.flatnonzero(a == 10))
        line = lines[np.searchsorted(lines, s[1:]) - 1]
        first = _join(_TRUE, (line >= e[:-1]) | _STOP[a[e[:-1] - 1]])
        cut = first.copy()
        if n > window:
            place = np.minimum(np.arange(s[0], len(a)) - np.repeat(s, np.diff(_join(s, _ZERO + len(a)))), 255)
            h = mix(np.add.reduceat(_BYTE[a[s[0]:]] * _PLACE[place], s - s[0]))
            key = np.empty(n, np.uint64)
            key[1:] = mix(h[1:] + h[:-1] * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
            key[first] = 0
            windows = np.ndarray((n - window + 1, window), np.uint64, key, 0, (8, 8))
            cut[windows.argmin(axis=1) + np.arange(n - window + 1)] = True
        c = np.flatnonzero(cut)
        if n > window and ((key[c[1:]] == key[c[:-1]]) & ~first[c[1:]]).any():
            kept, stop = [0], _join(c[1:], _ZERO + n)
            for k, after, v, f in zip(c[1:].tolist(), stop[1:].tolist(), key[c[1:]].tolist(), first[c[1:]].tolist()):
                if f or v != key[kept[-1]] or after - kept[-1] > window:
                    kept.append(k)
            c = np.array(kept)
        s[0] = 0
        self.at, self.total, self.sent = s[c], _join(c, _ZERO + n), np.cumsum(first)[c]

    def pieces(self, raw: bytes) -> list[bytes]:
        return [raw[a:b] for a, b in zip(self.at.tolist(), [*self.at[1:].tolist(), len(raw)])]

    def runs(self, min_sentences: int, min_words: int, long: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The spans: number (2 x first piece, or 2 x last piece + 1), first piece, piece after the last."""
        m, total, sent = len(self.at), self.total, self.sent
        i = np.arange(m if self.canon else 0)
        if not len(i):
            return i, i, i
        stop = np.maximum(np.searchsorted(total, total[:-1] + min_words),
                          np.minimum(np.searchsorted(sent, sent + min_sentences - 1) + 1, np.searchsorted(total, total[:-1] + long + 1)))
        back = np.minimum(np.searchsorted(total, total[1:] - min_words, side="right"),
                          np.maximum(np.searchsorted(sent, sent - min_sentences + 1, side="right"),
                                     np.searchsorted(total, total[1:] - long - 1, side="right"))) - 1
        on, ends = stop <= m, (back >= 0) & (stop[back] <= i)  # else the span that starts there ends with this piece too
        return _join(2 * i[on], 2 * i[ends] + 1), _join(i[on], back[ends]), _join(stop[on], i[ends] + 1)

    def hashes(self, first: np.ndarray, stop: np.ndarray) -> list[bytes]:
        digest, canon = xxhash.xxh3_128_digest, self.canon
        return [digest(canon[x:y]) for x, y in zip(self.word[self.total[first]].tolist(), (self.word[self.total[stop]] - 1).tolist())]


def sentences(text: str, window: int = WINDOW) -> list[str]:
    """Pieces of the text, in order and without loss; a piece without a word belongs to the piece before it, at the start after it."""
    raw = text.encode()
    return [p.decode() for p in _Text(raw, window).pieces(raw)]


def spans(pieces: list[str], min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS, long: int = LONG,
          window: int = WINDOW) -> list[tuple[bytes, int, int]]:
    """(128-bit hash, first piece, pieces) of the shortest span that starts with each piece, and of the shortest that
    ends with each where that is another one, where one is complete."""
    text = _Text("".join(pieces).encode(), window)
    _, first, stop = text.runs(min_sentences, min_words, long)
    return list(zip(text.hashes(first, stop), first.tolist(), (stop - first).tolist()))


def _emit(min_sentences: int, min_words: int, long: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            keys, row, number = [], [], []
            for i, t in enumerate(part.column("text").to_pylist()):
                text = _Text((t or "").encode())
                code, first, stop = text.runs(min_sentences, min_words, long)
                keys += text.hashes(first, stop)
                row.append(np.full(len(code), i))
                number.append(code)
            if not keys:
                continue
            h = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            idx = pa.array(np.concatenate(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[:, 0]), pa.array(h[:, 1]), part.column("id0").take(idx), part.column("text_key").take(idx),
                 pa.array(np.concatenate(number), pa.int64())], names=["hi", "lo", "id0", "text_key", "number"])
    return run


def _remove(min_sentences: int, min_words: int, long: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts, counts, gone = part.column("text").to_pylist(), [], []
            for i, drops in enumerate(part.column("drops").to_pylist()):
                raw = (texts[i] or "").encode()
                text = _Text(raw)
                stay = np.ones(len(text.at), bool)
                if drops:
                    code, first, stop = text.runs(min_sentences, min_words, long)
                    at = np.isin(code, drops)
                    for a, b in zip(first[at].tolist(), stop[at].tolist()):
                        stay[a:b] = False
                counts.append(len(stay))
                gone.append(len(stay) - int(stay.sum()))
                texts[i] = b"".join(p for p, s in zip(text.pieces(raw), stay.tolist()) if s).decode() if gone[-1] else texts[i] or ""
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(gone, pa.int64())],
                names=names)
    return run


def substring_dedup(docs: DataFrame, min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS, long: int = LONG) -> DataFrame:
    """``row`` (a struct of all columns but text), ``text`` without the repeats, ``n_sentences`` and ``n_removed`` (pieces)."""
    id0 = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("id0")
    key = F.xxhash64("text").alias("text_key")
    emit = _emit(min_sentences, min_words, long)
    found = docs.select(id0, key, "text").mapInArrow(emit, "hi long, lo long, id0 long, text_key long, number long")
    # what is shuffled for every span is kept small: 88 bits of its hash, and in the place 32 bits that tell rows of one id apart
    low = F.col("lo").bitwiseAND(F.lit(0xFFFFFF)).alias("low")
    place = F.struct("id0", F.shiftleft("text_key", 32).bitwiseOR(F.col("number")).alias("at"))
    repeated = found.groupBy("hi", low).agg(F.min(place).alias("one"), F.count("*").alias("n"))
    repeated = repeated.where("n > 1").select(F.col("hi").alias("__hi"), F.col("low").alias("__low"), "one")
    packed = found.select("hi", F.shiftleft(low, 40).bitwiseOR(F.col("number")).alias("number"), "id0", "text_key")
    later = packed.join(repeated, (packed["hi"] == repeated["__hi"]) & (F.shiftrightunsigned("number", 40) == F.col("__low")))
    later = later.withColumn("number", F.col("number").bitwiseAND(F.lit(2**40 - 1))).where(place != F.col("one"))
    drops = later.groupBy(F.col("id0").alias("__i"), F.col("text_key").alias("__t")).agg(F.collect_set("number").alias("drops"))
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), "text", id0, key)
    joined = rows.join(drops, (rows["id0"] == drops["__i"]) & (rows["text_key"] == drops["__t"]), "left")
    out = T.StructType([rows.schema["row"], T.StructField("text", T.StringType()),
                        T.StructField("n_sentences", T.LongType()), T.StructField("n_removed", T.LongType())])
    return joined.select("row", "text", "drops").mapInArrow(_remove(min_sentences, min_words, long, out.names), out)
