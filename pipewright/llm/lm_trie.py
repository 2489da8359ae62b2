"""Bigram language model in sharded Elias-Fano tries.

p(w | v) = (c(v w) + MU * p1(w)) / (c(v) + MU), p1(w) = (c(w) + 1) / (N + V + 1)
(Dirichlet smoothing towards the add-one unigram, which leaves 1 / (N + V + 1)
for an unknown word). Counts come from all training documents.

1. Word counts of the whole corpus give N, V and the hot words: those with
   more than 1/4 of a shard's share of the tokens (so at most 4 x shards words
   are sent to the tasks).
2. Documents are dealt to buckets by hash. A bucket sends each shard its
   distinct (context, successor) pairs with their training counts, packed. A
   pair belongs to its context's shard; those of a hot context are spread by
   their successor.
3. A shard sums up the counts and writes a trie: sorted contexts, monotone
   pointers to their successors (Elias-Fano), successors as context-relative
   ranks made monotone (Elias-Fano), and one byte per pair with the quantised
   log10 of c(v w) / (c(v) + MU). The levels are memory-mapped from a
   temporary file and queried for every pair each bucket sent, by a successor
   search within the context's range; the answer is one byte per pair
   (0: unseen) and the counts of its contexts.
4. A bucket meets the answers and sums up its documents.

Within a context a successor is known by 48 bits of its hash (two successors
of one context that agree in them would share a probability; the counts of
words use all 64 bits). What travels is one entry per distinct pair of a bucket, twice; no task holds
more than one bucket or one shard, and both numbers grow with the tokens.

Edge cases: null or empty text is the end token alone; without any training
document every count is 0 and p is 1; rows without id are in the fold of the
empty text; repeated rows are trained on and scored each; an empty table gives
an empty result; extra columns are ignored whatever their names.
"""

from __future__ import annotations

import mmap
import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pipewright.llm.common import cut, fold, mix, partitions, slices, word_hashes
from pipewright.llm.elias_fano import EliasFano

MU = 50.0
FOLDS, HELD = 7, 2
BUCKET_TOKENS = 1_500_000
BOS, END = np.uint64(0x424F53), np.uint64(0x454E44)  # not words; a word hashing to one is as unlikely as any collision
LEVELS = 255
SENT = "shard int, b int, ctx binary, runs binary, succ binary, train binary"
ANSWER = "b int, shard int, counts binary, codes binary"
SCORED = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _short(h: np.ndarray) -> bytes:
    """The low 48 bits of each hash, packed."""
    return np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _long(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def _counts(c: np.ndarray) -> bytes:
    """Counts in the fewest of 1, 2 or 4 bytes that hold them all, after a byte that says how many."""
    width = next(w for w in (1, 2, 4) if w == 4 or not len(c) or int(c.max()) < 256 ** w)
    return bytes([width]) + c.astype(f"<u{width}").tobytes()


def _counted(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"<u{packed[0]}", offset=1)


@dataclass
class Stats:
    tokens: int           # N
    vocabulary: int       # V
    documents: int        # training documents
    shards: int
    hot: np.ndarray       # sorted hashes of hot contexts, BOS included
    hot_counts: np.ndarray

    @property
    def floor(self) -> float:
        """Smallest log10 probability that the bytes have to tell apart."""
        return -np.log10(self.tokens + MU + 1)

    def is_hot(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.hot, h), len(self.hot) - 1)
        hot = self.hot[at] == h
        return hot, np.where(hot, self.hot_counts[at], 0)

    def quantise(self, p: np.ndarray) -> np.ndarray:
        """1 .. LEVELS, uniform in log10 p."""
        return np.clip(np.rint(1 + (LEVELS - 1) * (1 - np.log10(p) / self.floor)), 1, LEVELS).astype(np.uint8)

    def value(self, code: np.ndarray) -> np.ndarray:
        return np.where(code > 0, 10 ** (self.floor * (1 - (code.astype(float) - 1) / (LEVELS - 1))), 0.0)


class Trie:
    """Contexts, their successors and a byte per pair; see the module text."""

    def __init__(self, contexts, words, pointers: EliasFano, successors: EliasFano, codes):
        self.contexts, self.words, self.pointers, self.successors, self.codes = contexts, words, pointers, successors, codes

    @classmethod
    def build(cls, ctx: np.ndarray, succ: np.ndarray, codes: np.ndarray) -> Trie:
        """Pairs sorted by (context, successor), distinct."""
        contexts, first = np.unique(ctx, return_index=True)
        words = np.unique(succ)
        rank = np.searchsorted(words, succ) + np.repeat(np.arange(len(contexts)), np.diff(np.r_[first, len(ctx)])) * len(words)
        return cls(contexts, words, EliasFano.encode(np.r_[first, len(ctx)], len(ctx) + 1),
                   EliasFano.encode(rank, len(contexts) * len(words) + 1), codes)

    def query(self, ctx: np.ndarray, succ: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ctx), np.uint8)
        if not len(self.contexts):
            return out
        c = np.minimum(np.searchsorted(self.contexts, ctx), len(self.contexts) - 1)
        w = np.minimum(np.searchsorted(self.words, succ), len(self.words) - 1)
        known = np.flatnonzero((self.contexts[c] == ctx) & (self.words[w] == succ))
        c, want = c[known], w[known] + c[known] * len(self.words)
        lo, hi = self.pointers.get(c), self.pointers.get(c + 1)
        at = self.successors.successor(want, lo, hi)
        found = at < hi
        found[found] = self.successors.get(at[found]) == want[found]
        out[known[found]] = self.codes[at[found]]
        return out

    def save(self, path: str) -> None:
        (h1, d1), (h2, d2) = self.pointers.dump(), self.successors.dump()
        with open(path, "wb") as f:
            f.write(np.r_[len(self.contexts), len(self.words), h1, h2, len(self.codes)].astype(np.int64).tobytes())
            for a in (self.contexts, self.words, *d1, *d2, self.codes):
                f.write(np.ascontiguousarray(a).tobytes())

    @classmethod
    def open(cls, path: str) -> Trie:
        """Levels mapped from the file, not read."""
        with open(path, "rb") as f:
            data = np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), np.uint8)
        head = data[:88].view(np.int64)
        c, w, codes = int(head[0]), int(head[1]), int(head[10])
        at, levels = 88, []
        for size in (8 * c, 8 * w, int(head[4] + head[5]), int(head[8] + head[9]), codes):
            levels.append(data[at:at + size])
            at += size
        return cls(levels[0].view(np.uint64), levels[1].view(np.uint64), EliasFano.load(head[2:6], levels[2]),
                   EliasFano.load(head[6:10], levels[3]), levels[4])


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        h, ends = word_hashes(part.column("text"))
        words, of = np.unique(h, return_inverse=True)
        train = np.repeat(pc.invert(part.column("held_out")).to_numpy(zero_copy_only=False), np.diff(ends))
        both = (pa.array(np.r_[words, END].view(np.int64)),
                pa.array(np.r_[np.bincount(of, train, len(words)), part.num_rows - pc.sum(part.column("held_out")).as_py()].astype(np.int64)),
                pa.array(np.r_[np.bincount(of, minlength=len(words)), part.num_rows].astype(np.int64)))
        yield pa.RecordBatch.from_arrays(list(both), names=["h", "train", "n"])


def statistics(docs: DataFrame) -> Stats:
    """One aggregate over all words; N, V, the number of documents and the hot words reach the driver."""
    counts = docs.select("text", "held_out").mapInArrow(_word_counts, "h long, train long, n long")
    counts = cut(counts.groupBy("h").agg(F.sum("train").alias("train"), F.sum("n").alias("n")))
    t = counts.agg(F.sum("train"), F.count(F.when(F.col("train") > 0, 1)), F.sum("n"),
                   F.max(F.when(F.col("h") == int(END), F.col("train")))).first()
    n, v, every, ends = (int(x or 0) for x in t)
    shards = max(partitions(docs.sparkSession), -(-every // BUCKET_TOKENS))
    hot = counts.where((F.col("train") > n / (4 * shards)) & (F.col("h") != int(END))).select("h", "train").collect()
    h = np.array([int(BOS), *(r["h"] & (2**64 - 1) for r in hot)], np.uint64)
    c = np.array([ends, *(r["train"] for r in hot)], np.int64)
    order = np.argsort(h)
    return Stats(n, v, ends, shards, h[order], c[order])


class _Bucket:
    """The tokens of a bucket and its distinct pairs, in an order that does not depend on the order of its rows."""

    def __init__(self, table: pa.Table, stats: Stats):
        hashes, ends = [], [np.zeros(1, np.int64)]
        for part in slices(iter(table.select(["text"]).combine_chunks().to_batches())):
            h, e = word_hashes(part.column("text"))
            hashes.append(h)
            ends.append(e[1:] + ends[-1][-1])
        h, ends = np.concatenate(hashes), np.concatenate(ends)
        n = table.num_rows
        self.ends = ends + np.arange(n + 1)  # with an end token each
        nxt = np.full(len(h) + n, END, np.uint64)
        nxt[np.arange(len(h)) + np.repeat(np.arange(n), np.diff(ends))] = h
        self.words, nxt = np.unique(np.r_[nxt, BOS], return_inverse=True)
        self.token = nxt[:-1]
        ctx = np.r_[nxt[-1], self.token[:-1]]
        ctx[self.ends[:-1]] = nxt[-1]
        pairs, self.pair = np.unique(ctx * len(self.words) + self.token, return_inverse=True)
        c, s = pairs // len(self.words), pairs % len(self.words)
        hot, _ = stats.is_hot(self.words)
        home = mix(self.words)
        shard = np.where(hot[c], mix(self.words[c] ^ home[s]), home[c]) % np.uint64(stats.shards)
        self.order = np.argsort(shard, kind="stable")
        self.shard, self.ctx, self.succ = shard[self.order].astype(np.int32), c[self.order], s[self.order]
        self.starts = np.flatnonzero(np.r_[True, (np.diff(self.shard) != 0) | (np.diff(self.ctx) != 0)])


def _send(stats: Stats):
    def run(table: pa.Table) -> pa.Table:
        b = _Bucket(table, stats)
        train = np.repeat(pc.invert(table.column("held_out")).to_numpy(), np.diff(b.ends))
        count = np.bincount(b.pair, train, len(b.order)).astype(np.int64)[b.order]
        runs = np.diff(np.r_[b.starts, len(b.order)])
        cuts = np.flatnonzero(np.r_[True, np.diff(b.shard) != 0])
        out = []
        for x, y in zip(cuts, np.r_[cuts[1:], len(b.order)]):
            i, j = np.searchsorted(b.starts, [x, y])
            out.append((int(b.shard[x]), b.words[b.ctx[b.starts[i:j]]].tobytes(), _counts(runs[i:j]),
                        _short(b.words[b.succ[x:y]]), _counts(count[x:y])))
        shard, ctx, run_, succ, tr = zip(*out)
        own = pa.array([table.column("b")[0].as_py()] * len(out), pa.int32())
        return pa.table([pa.array(shard, pa.int32()), own, *(pa.array(v, pa.binary()) for v in (ctx, run_, succ, tr))],
                        names=["shard", "b", "ctx", "runs", "succ", "train"])
    return run


def _answer(stats: Stats):
    def run(table: pa.Table) -> pa.Table:
        rows = []
        for i in range(table.num_rows):
            ctx, runs, succ, train = (table.column(c)[i].as_py() for c in ("ctx", "runs", "succ", "train"))
            ctx = np.frombuffer(ctx, np.uint64)
            rows.append((ctx, np.repeat(ctx, _counted(runs)), _long(succ), _counted(train)))
        ctx, succ = np.concatenate([r[1] for r in rows]), np.concatenate([r[2] for r in rows])
        train = np.concatenate([r[3] for r in rows]).astype(np.int64)
        seen = np.flatnonzero(train > 0)
        order = seen[np.lexsort((succ[seen], ctx[seen]))]
        c, s = ctx[order], succ[order]
        new = np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | (s[1:] != s[:-1])][:len(c)])
        n = np.add.reduceat(train[order], new) if len(new) else np.zeros(0, np.int64)
        c, s = c[new], s[new]
        contexts, first = np.unique(c, return_index=True)
        own = np.add.reduceat(n, first) if len(first) else np.zeros(0, np.int64)
        hot, whole = stats.is_hot(contexts)
        total = np.where(hot, whole, own)
        codes = stats.quantise(n / (np.repeat(total, np.diff(np.r_[first, len(c)])) + MU))
        fd, path = tempfile.mkstemp(prefix="trie-")
        os.close(fd)
        try:
            Trie.build(c, s, codes).save(path)
            trie = Trie.open(path)
            counts, out = [], []
            for asked, cx, sx, _ in rows:
                at = np.minimum(np.searchsorted(contexts, asked), max(0, len(contexts) - 1))
                counts.append((np.where(contexts[at] == asked, total[at], 0) if len(contexts) else np.zeros(len(asked), np.int64)).tobytes())
                out.append(trie.query(cx, sx).tobytes())
        finally:
            os.unlink(path)
        return pa.table([table.column("b"), table.column("shard"), pa.array(counts, pa.binary()), pa.array(out, pa.binary())],
                        names=["b", "shard", "counts", "codes"])
    return run


def _score(stats: Stats):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        b = _Bucket(table, stats)
        answers = answers.sort_by("shard")
        codes = np.empty(len(b.order), np.uint8)
        codes[b.order] = np.frombuffer(b"".join(answers.column("codes").to_pylist()), np.uint8)
        count = np.zeros(len(b.words), np.int64)
        count[b.ctx[b.starts]] = np.frombuffer(b"".join(answers.column("counts").to_pylist()), np.int64)
        hot, whole = stats.is_hot(b.words)
        count = np.where(hot, whole, count)
        count[np.searchsorted(b.words, END)] = stats.documents
        norm = stats.tokens + stats.vocabulary + 1
        one = (count + 1) / norm
        bos = int(np.searchsorted(b.words, BOS))
        ctx = np.r_[bos, b.token[:-1]]
        ctx[b.ends[:-1]] = bos
        p = stats.value(codes)[b.pair] + MU / (count[ctx] + MU) * one[b.token]
        at = b.ends[:-1]
        base = np.add.reduceat(np.log10(one)[b.token], at)
        return pa.table([
            table.column("doc_id"), table.column("held_out"), pa.array(np.diff(b.ends)),
            pa.array(np.add.reduceat((count > 0)[b.token].astype(np.int64), at)),
            pa.array(np.full(table.num_rows, stats.tokens, np.int64)), pa.array(base),
            pa.array(np.add.reduceat(np.log10(p), at))], names=[x.split()[0] for x in SCORED.split(", ")])
    return run


def lm_scores(docs: DataFrame, folds: int = FOLDS, held: int = HELD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    width = partitions(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       (fold(F.col("doc_id"), folds) == held).alias("held_out"))
    stats = statistics(slim)
    slim = slim.withColumn("b", F.pmod(F.xxhash64("doc_id", "text"), F.lit(stats.shards)).cast("int"))
    dealt = slim.repartition(width, "b")
    answers = dealt.groupBy("b").applyInArrow(_send(stats), SENT).groupBy("shard").applyInArrow(_answer(stats), ANSWER)
    return dealt.groupBy("b").cogroup(answers.groupBy("b")).applyInArrow(_score(stats), SCORED)
