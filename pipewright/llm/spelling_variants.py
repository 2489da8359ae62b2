"""Spelling variants: words one edit apart, found over a reduced alphabet.

1. Words are counted per task and summed up by one shuffle.
2. Every letter is hashed to one of ``SYMBOLS`` symbols. Words one edit apart have
   reduced words that are equal or one edit apart, so the full one-edit neighbourhood of
   each reduced word (itself, all deletions, replacements and insertions) is generated,
   as hashes: with the sums before and after a place, each neighbour costs a few
   operations, however long the word.
3. Neighbours meet the reduced vocabulary by a join on the hash. A bitmap of the reduced
   vocabulary, of ``BITS`` bits whatever its size, drops most neighbours that no word has
   before the shuffle; once it is full it drops none, and the join alone decides.
4. Each pair is verified on the original strings (edit distance of exactly 1), and a
   word's near words are summed up: their number, and the most frequent one.
5. Roots by pointer jumping: counts at least double along a chain, so it is short.

Edge cases: null text has no words, a null id counts as the empty text; equal rows count
each; words may have any length; ties go to the smallest word in code-point order; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pipewright.llm.common import mix, slices, store

MIN_CHARS, MIN_COUNT, RATIO = 5, 3, 2
TYPO_EVERY = 97
SYMBOLS = 8
BITS = 26  # log2 of the bitmap's bits: 8 MB
LETTERS = 50_000  # letters whose neighbourhoods a task holds at once (one word at least)
WORDS = 400_000  # different words a task counts before it sends them on
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_LENGTH = np.uint64(0xA0761D6478BD642F)


def _count(min_chars: int, typo_every: int):
    runs = re.compile(f"[a-zÀ-ÿ]{{{min_chars},}}")  # a maximal run, as shorter ones match nowhere

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def pack():
            out = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        crc = zlib.crc32
        for part in slices(batches):
            for doc, text in zip(part.column("id").to_pylist(), pc.ascii_lower(part.column("text")).to_pylist()):
                start = crc(f"{doc}:".encode())
                for word, n in Counter(runs.findall(text or "")).items():
                    h = crc(word.encode(), start)
                    if h % typo_every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < min_chars:
                            continue
                    total[word] += n
                if len(total) > WORDS:
                    yield pack()
        if total:
            yield pack()
    return run


def misspelt_words(docs: DataFrame, min_chars: int = MIN_CHARS, typo_every: int = TYPO_EVERY) -> DataFrame:
    """(word, n): runs of letters, A-Z lowered; in one of ``typo_every`` (document, run) pairs a letter is missing."""
    slim = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    return slim.mapInArrow(_count(min_chars, typo_every), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _symbols(words: list[str], symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols 1 to ``symbols`` of all words, flat, and where each word begins."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    ends = np.r_[0, np.cumsum([len(w) for w in words])].astype(np.int64)
    return mix(codes + np.uint64(1)) % np.uint64(symbols) + np.uint64(1), ends


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(n, base, np.uint64)], dtype=np.uint64)


class _Reduced:
    """Hashes of reduced words and of their neighbours."""

    def __init__(self, words: list[str], symbols: int):
        self.symbols = symbols
        self.s, self.ends = _symbols(words, symbols)
        self.size = np.diff(self.ends)
        self.word = np.repeat(np.arange(len(words)), self.size)
        self.place = np.arange(len(self.s)) - self.ends[self.word]
        self.power = _powers(_BASE, int(self.size.max(initial=0)) + 1)
        sums = np.r_[np.uint64(0), np.cumsum(self.s * self.power[self.place], dtype=np.uint64)]
        self.before = sums[:-1] - sums[self.ends[self.word]]  # of each letter, in its word
        self.total = sums[self.ends[1:]] - sums[self.ends[:-1]]

    def _done(self, value: np.ndarray, size: np.ndarray) -> np.ndarray:
        return mix(value + size.astype(np.uint64) * _LENGTH)

    def own(self) -> np.ndarray:
        return self._done(self.total, self.size)

    def neighbours(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(word, hash) of itself and all one-edit neighbours, edit by edit."""
        every = np.arange(len(self.size))
        w, power, size = self.word, self.power[self.place], self.size[self.word]
        after = self.total[w] - self.before - self.s * power
        yield every, self.own()
        yield w, self._done(self.before + after * _INVERSE, size - 1)
        for c in range(1, self.symbols + 1):
            u = np.uint64(c)
            other = self.s != u
            yield w[other], self._done(self.before + u * power + after, size)[other]
            yield w, self._done(self.before + u * power + (self.total[w] - self.before) * _BASE, size + 1)
            yield every, self._done(self.total + u * self.power[self.size], self.size + 1)


def _reduce(symbols: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "word"):
            own = _Reduced(part.column("word").to_pylist(), symbols).own()
            yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), part.column("word"), part.column("n")],
                                             names=["reduced", "word", "n"])
    return run


def _generate(symbols: int, bitmap, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            words = batch.column("word").to_pylist()
            part = np.cumsum([len(w) for w in words]) // LETTERS
            starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]][:len(words)])
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(words)]):
                found = []
                for word, h in _Reduced(words[a:b], symbols).neighbours():
                    at = h >> np.uint64(64 - bits)
                    some = (seen[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    found.append((word[some], h[some]))
                word, h = (np.concatenate(x) for x in zip(*found))
                order = np.lexsort((h, word))  # different edits can give one neighbour
                word, h = word[order], h[order]
                new = np.r_[True, (word[1:] != word[:-1]) | (h[1:] != h[:-1])][:len(word)]
                take = pa.array(word[new] + a)
                yield pa.RecordBatch.from_arrays([pa.array(h[new].view(np.int64)), batch.column("word").take(take)],
                                                 names=["neighbour", "word"])
    return run


def _bitmap(reduced: DataFrame, bits: int) -> bytes:
    """Bits of the hashes' first ``bits`` bits that occur: 2 ** bits / 8 bytes, whatever the number of rows."""
    bit = F.shiftrightunsigned("reduced", 64 - bits)
    rows = reduced.select(F.shiftright(bit, 15).alias("bucket"), bit.bitwiseAND(F.lit(2**15 - 1)).alias("bit"))
    out = bytearray(max(2**bits // 8, 2**12))
    for r in rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("map")).toLocalIterator():
        out[r.bucket * 2**12:(r.bucket + 1) * 2**12] = r.map
    return bytes(out)


def near_words(vocabulary: DataFrame, symbols: int = SYMBOLS, bits: int = BITS) -> DataFrame:
    """(word, near, near_n): all ordered pairs of words of ``vocabulary`` (word, n) that are exactly one edit apart."""
    spark = vocabulary.sparkSession
    reduced = store(vocabulary.mapInArrow(_reduce(symbols), "reduced long, word string, n long"))
    bitmap = spark.sparkContext.broadcast(_bitmap(reduced, bits))
    asked = vocabulary.select("word").mapInArrow(_generate(symbols, bitmap, bits), "neighbour long, word string")
    held = reduced.select("reduced", F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = asked.join(held, F.col("neighbour") == F.col("reduced"))
    return pairs.where((F.abs(F.length("word") - F.length("near")) <= 1) & (F.levenshtein("word", "near", 1) == 1)).select("word", "near", "near_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, form) -> (word, root): every word is sent to the form of its form until none moves."""
    at = store(forms.select("word", F.col("form").alias("root")))
    while True:
        to = at.select(F.col("word").alias("__w"), F.col("root").alias("__r"))
        at = store(at.join(to, F.col("root") == F.col("__w"), "left").select(
            "word", F.coalesce("__r", "root").alias("root"), F.col("__r").isNotNull().alias("moved")))
        if at.where("moved").limit(1).count() == 0:
            return at.select("word", "root")


def variants(words: DataFrame, min_count: int = MIN_COUNT, ratio: int = RATIO, symbols: int = SYMBOLS, bits: int = BITS) -> DataFrame:
    """Per word of ``words`` (word, n) with at least ``min_count``: word, form, root, n, n_near, form_n."""
    vocabulary = store(words.where(F.col("n") >= min_count).select("word", "n"))
    near = near_words(vocabulary, symbols, bits).groupBy(F.col("word").alias("__word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    is_form = -F.col("best.minus") >= F.col("n") * ratio
    rows = store(vocabulary.join(near, F.col("word") == F.col("__word"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.minus")).alias("form_n")))
    roots = _roots(rows.where("form is not null")).select(F.col("word").alias("__w"), F.col("root").alias("__root"))
    return rows.join(roots, F.col("word") == F.col("__w"), "left").select(
        "word", "form", F.coalesce("__root", "word").alias("root"), "n", "n_near", "form_n")
