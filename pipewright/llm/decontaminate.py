"""Benchmark decontamination with a generalised suffix automaton of the benchmark's words.

Words are runs of digits, a-z (A-Z lowered) and non-ASCII characters. A
benchmark item's windows are its runs of ``window`` words; an item of fewer
words is one window. Document words are streamed through the automaton, which
tracks the longest match ending at each word; every word inside an occurrence
of a window is hit. Spans of hit words are removed from the text (a match of at
least ``window`` words, or one that covers a whole shorter item), and a document of
whose words more than ``max_coverage`` are hit is dropped.

The benchmark is cut into pieces of at most ``PIECE`` words (overlapping by
window - 1, so no window is lost) and dealt to blocks of about ``BLOCK_WORDS``
words. Each block becomes one automaton, built in a task and broadcast; its
size is bounded by the block's. Documents pass through all blocks in one
stage, ``PER_PASS`` blocks to a Python worker; no document is ever shuffled.

Words whose neighbours never stand together in the benchmark end a match, so
only runs of benchmark word pairs are walked; the test is a bit table, and a
false positive costs a walk, not a result.

Edge cases: null text has no words and no hit; items that are null, empty or
without words have no window; items that share an id count as one item; a null
item_id is named 'null'; an empty benchmark hits nothing; repeated document
rows each get their result; extra columns pass through whatever their names.
"""

from __future__ import annotations

import math
import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pipewright.llm.common import slices
from pipewright.llm.suffix_automaton import Automaton

WINDOW = 10
MAX_COVERAGE = 0.5
PIECE = 5_000
BLOCK_WORDS = 200_000
PER_PASS = 4
WORDS = rb"[0-9a-zA-Z\x80-\xff]+"
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
PAIR_BITS = 22


def _words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Flat words of the texts and each text's offsets."""
    text = pc.fill_null(text, "").cast(pa.large_string())
    _, offsets, data = text.buffers()
    clean = pa.py_buffer((data.to_pybytes() if data else b"").translate(_FOLD))
    text = pa.Array.from_buffers(pa.large_string(), len(text), [None, offsets, clean], offset=text.offset)
    lists = pc.ascii_split_whitespace(text)
    flat = lists.flatten()
    ends = np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)]
    real = pc.greater(pc.binary_length(flat), 0)
    if not pc.all(real).as_py():
        ends = np.r_[0, np.cumsum(real.to_numpy(zero_copy_only=False), dtype=np.int64)][ends]
        flat = flat.filter(real)
    return flat, ends


def _pieces(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            flat, ends = _words(part.column("text"))
            out = []
            for item, a, b in zip(part.column("item").to_pylist(), ends[:-1].tolist(), ends[1:].tolist()):
                for s in range(a, max(a + 1, b - window + 1), PIECE - window + 1):
                    if b > a:
                        out.append((item, b - a < window, " ".join(flat.slice(s, min(PIECE, b - s)).to_pylist())))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["item", "short", "piece"])
    return run


def _build(window: int):
    def run(table: pa.Table) -> pa.Table:
        """One block: vocabulary, automaton, bit table of word pairs, items by window state and short items by state."""
        seqs = [s.split(" ") for s in table.column("piece").to_pylist()]
        items, short = table.column("item").to_pylist(), table.column("short").to_pylist()
        vocab = {w: i for i, w in enumerate(sorted({w for s in seqs for w in s}))}
        ids = [[vocab[w] for w in s] for s in seqs]
        a = Automaton.build(ids, len(vocab))
        at = a.at_length(window)
        windows: dict[int, set[str]] = {}
        whole: dict[int, set[tuple[int, str]]] = {}
        pairs = np.zeros(1 << PAIR_BITS, bool)
        for s, item, is_short in zip(ids, items, short):
            state = 0
            for j, w in enumerate(s):
                state = a.next(state, w)
                if not is_short and j + 1 >= window:
                    windows.setdefault(int(at[state]), set()).add(item)
            if is_short:
                whole.setdefault(state, set()).add((len(s), item))
            v = np.array(s, np.int64)
            pairs[_pair_code(v[:-1], v[1:])] = True
        up = np.full(len(a.length), -1, np.int32)  # nearest suffix state, itself included, with short items
        for s in np.argsort(a.length, kind="stable").tolist():
            up[s] = s if s in whole else (up[a.link[s]] if a.link[s] >= 0 else -1)
        blob = pickle.dumps({
            "vocab": list(vocab), "automaton": (a.length, a.link, a.keys, a.to, len(vocab)), "at": at, "up": up,
            "pairs": np.packbits(pairs), "windows": {k: sorted(v) for k, v in windows.items()},
            "whole": {k: sorted(v) for k, v in whole.items()},
            "least": min([window] + [n for v in whole.values() for n, _ in v])})
        return pa.table({"block": table.column("block").slice(0, 1), "blob": pa.array([blob], pa.binary())})
    return run


def _pair_code(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


class Block:
    """A loaded block; ``scan`` gives the hit words of a slice and the items found per document."""

    def __init__(self, blob: bytes, window: int):
        d = pickle.loads(blob)
        self.__dict__.update(d)
        self.automaton = Automaton(*d["automaton"])
        self.vocab = pa.array(d["vocab"], pa.large_string())
        self.pairs = np.unpackbits(d["pairs"]).astype(bool)
        self.window = window

    def scan(self, flat: pa.Array, ends: np.ndarray, hit: np.ndarray, found: dict[int, set[str]]) -> None:
        ids = pc.fill_null(pc.index_in(flat, value_set=self.vocab), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        known = ids >= 0
        joined = np.zeros(len(ids), bool)  # word j continues a run with word j - 1
        j = np.flatnonzero(known[1:] & known[:-1]) + 1
        joined[j] = self.pairs[_pair_code(ids[j - 1], ids[j])]
        first = ends[:-1]
        joined[first[first < len(ids)]] = False
        starts = np.flatnonzero(known & ~joined)
        stops = np.r_[starts[1:], len(ids)]
        # a run ends at the next start or at the first unknown word
        bad = np.flatnonzero(~known)
        nxt = np.searchsorted(bad, starts)
        stops = np.minimum(stops, np.r_[bad, len(ids)][nxt])
        long = stops - starts >= self.least
        docs = np.searchsorted(ends, starts[long], side="right") - 1
        for a, b, doc in zip(starts[long].tolist(), stops[long].tolist(), docs.tolist()):
            self._walk(a, ids[a:b].tolist(), hit, found, doc)

    def _walk(self, start: int, words: list[int], hit: np.ndarray, found: dict[int, set[str]], doc: int) -> None:
        state, matched, step = 0, 0, self.automaton.step
        for j, w in enumerate(words, start):
            state, matched = step(state, matched, w)
            if matched >= self.window:
                hit[j - self.window + 1:j + 1] = True
                if (k := int(self.at[state])) in self.windows:
                    found.setdefault(doc, set()).update(self.windows[k])
            s = int(self.up[state])
            while s >= 0:
                for n, item in self.whole[s]:
                    if n <= matched:
                        hit[j - n + 1:j + 1] = True
                        found.setdefault(doc, set()).add(item)
                p = int(self.automaton.link[s])
                s = int(self.up[p]) if p >= 0 else -1


def _spans(hit: np.ndarray) -> np.ndarray:
    edge = np.diff(np.r_[0, hit.astype(np.int8), 0])
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], axis=1)


def _scan(blobs, window: int, names: list[str]):
    """Adds the hits of some blocks to what earlier passes found (spans: word starts and stops; items)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [Block(b, window) for b in blobs.value]
        for part in slices(batches):
            flat, ends = _words(part.column("text"))
            hit = np.zeros(len(flat), bool)
            found: dict[int, set[str]] = {}
            for i in np.flatnonzero(pc.greater(pc.list_value_length(part.column("items")), 0).to_numpy(zero_copy_only=False)):
                found[int(i)] = set(part.column("items")[int(i)].as_py())
                for a, b in np.frombuffer(part.column("spans")[int(i)].as_py(), np.int64).reshape(-1, 2):
                    hit[ends[i] + a:ends[i] + b] = True
            for b in blocks:
                b.scan(flat, ends, hit, found)
            spans = [b""] * part.num_rows
            n_hit = np.zeros(part.num_rows, np.int64)
            for i in found:
                own = hit[ends[i]:ends[i + 1]]
                spans[i], n_hit[i] = _spans(own).astype(np.int64).tobytes(), own.sum()
            items = pa.array([sorted(found[i]) if i in found else [] for i in range(part.num_rows)], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("text"), pa.array(np.diff(ends)), pa.array(n_hit),
                 pa.array(spans, pa.binary()), items], names=names)
    return run


def _strip(names: list[str]):
    """Removes the spans from the texts, from the first byte of a span's first word to the last byte of its last."""
    find = re.compile(WORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = np.flatnonzero(pc.greater(part.column("n_hit"), 0).to_numpy(zero_copy_only=False)).tolist()
            text = part.column("text")
            if rows:
                values = text.to_pylist()
                for i in rows:
                    raw = values[i].encode()
                    at = np.array([m.span() for m in find.finditer(raw)])
                    keep, last = [], 0
                    for a, b in np.frombuffer(part.column("spans")[i].as_py(), np.int64).reshape(-1, 2):
                        keep.append(raw[last:at[a, 0]])
                        last = at[b - 1, 1]
                    values[i] = b"".join([*keep, raw[last:]]).decode()
                text = pa.array(values, pa.string())
            cols = [text if c == "clean" else part.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def blocks(benchmark: DataFrame, window: int = WINDOW) -> list[bytes]:
    """The packed automata of the benchmark, one per block of about ``BLOCK_WORDS`` words."""
    item = F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item")
    pieces = benchmark.select(item, "text").mapInArrow(_pieces(window), "item string, short boolean, piece string")
    total = pieces.agg(F.sum(F.size(F.split("piece", " ")))).first()[0] or 0
    n = math.ceil(total / BLOCK_WORDS)
    if n == 0:
        return []
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("piece"), F.lit(n)).cast("int"))
    built = dealt.groupBy("block").applyInArrow(_build(window), "block int, blob binary")
    return [r["blob"] for r in built.toLocalIterator()]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``row`` (a struct of all columns but text), text, n_words, n_hit, spans (packed word ranges) and items."""
    spark = docs.sparkSession
    others = [c for c in docs.columns if c != "text"]
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), "text",
                      F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                      F.lit(b"").alias("spans"), F.array().cast("array<string>").alias("items"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in out.schema])
    built = blocks(benchmark, window)
    for i in range(0, max(1, len(built)), PER_PASS):  # one pass without blocks counts the words
        held = spark.sparkContext.broadcast(built[i:i + PER_PASS])
        out = out.mapInArrow(_scan(held, window, schema.names), schema)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """``contamination`` with the cleaned text in ``clean`` and ``dropped`` (more than ``max_coverage`` of the words hit)."""
    found = contamination(docs, benchmark, window)
    schema = T.StructType([*found.schema.fields, T.StructField("clean", T.StringType())])
    d = found.mapInArrow(_strip(schema.names), schema)
    return d.withColumn("dropped", F.col("n_hit") > F.col("n_words") * F.lit(max_coverage))


def apply_decontamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                          max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """The rows of ``docs`` under the coverage limit, columns unchanged, benchmark spans removed from ``text``."""
    d = decontaminate(docs, benchmark, window, max_coverage).where(~F.col("dropped"))
    return d.select(*[F.col("clean").alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
