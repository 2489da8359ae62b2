"""Toxicity by a classifier chain of linear models.

Features are hashed distinct words and their prefixes. Categories are
predicted in order; each later model also gets the probabilities of the
earlier ones, in training as out-of-fold predictions (``K`` folds), so that it sees
them as they will be on new text. The last category is the labelled one.

``labels`` has one column per category. Where only ``toxic`` is labelled,
``derive`` splits the labelled positives by what marks them, which gives the
chain its earlier steps: 'marked' (a whole word that toxic documents alone
use), 'coined' (a prefix that only toxic documents use) and 'dense' (three
markers or more).

Trained on at most ``TRAIN_ROWS`` labelled documents (smallest hashes of the
doc_id) whose crc32(doc_id) mod ``FOLDS`` is not 0.

Edge cases: null or empty text has no features and gets the base rate; rows
without id or with a null label are not trained on; a doc_id labelled more than once gives a
training row each; a category without both classes predicts its constant; without
training rows every probability is 0; repeated rows are scored each; extra
columns are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pipewright.llm.common import fold, slices

BITS = 20
PREFIXES = (4, 5, 6)
TRAIN_ROWS = 6000
FOLDS = 5
K = 4
SELECT = 300       # features of a category: the largest absolute z-scores of the log odds ratio
STEPS, RATE, L2 = 150, 0.15, 1e-4
MARKER_DOCS = 5    # labelled documents that a marker needs


def _features(word: str) -> list[int]:
    h, mask = xxhash.xxh3_64_intdigest, (1 << BITS) - 1
    return [h(word) & mask] + [h(f"{k}:{word[:k]}") & mask for k in PREFIXES if len(word) > k]


def _words(text: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words of the slice (punctuation at the edges removed, lower case), and (text, word) pairs, distinct."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(text, "")))
    codes = lists.flatten().dictionary_encode()
    raw = [w.strip(".,;:!?\"'()[]{}*#$%&|<>-") for w in codes.dictionary.to_pylist()]
    names = {w: i for i, w in enumerate(dict.fromkeys(raw))}
    to = np.array([names[w] for w in raw], np.int64)
    word = to[codes.indices.to_numpy(zero_copy_only=False)] if len(codes) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(text)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    if "" in names:
        word, row = word[(real := word != names[""])], row[real]
    pair = np.unique(row * max(1, len(names)) + word)
    return list(names), pair // max(1, len(names)), pair % max(1, len(names))


class Chain:
    """Models in order; ``weights`` has one row per feature in use, ``given`` the weights of earlier probabilities."""

    def __init__(self, categories: list[str]):
        self.categories = categories
        self.ids = np.zeros(0, np.int64)
        self.weights = np.zeros((0, len(categories)))
        self.bias = np.full(len(categories), -np.inf)
        self.given = np.zeros((len(categories), len(categories)))

    def probabilities(self, sums: np.ndarray) -> np.ndarray:
        """``sums``: feature weights summed per text, one column per category."""
        p = np.zeros_like(sums)
        for c in range(sums.shape[1]):
            p[:, c] = _sigmoid(sums[:, c] + self.bias[c] + p[:, :c] @ self.given[c, :c])
        return p

    def fit(self, rows: list[np.ndarray], labels: np.ndarray) -> Chain:
        """``rows``: feature ids (with repetition) of each text; ``labels``: 0/1 per text and category."""
        of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        flat = np.concatenate(rows)
        picks = [_select(of, flat, labels[:, c]) for c in range(labels.shape[1])]
        self.ids = np.unique(np.concatenate(picks))
        at = np.searchsorted(self.ids, flat)
        ok = (at < len(self.ids)) & (self.ids[np.minimum(at, max(0, len(self.ids) - 1))] == flat) if len(self.ids) else np.zeros(len(flat), bool)
        x = np.zeros((len(rows), len(self.ids)), np.float32)
        np.add.at(x, (of[ok], at[ok]), 1)
        self.weights = np.zeros((len(self.ids), len(self.categories)))
        folds = np.arange(len(rows)) % K
        earlier = np.zeros((len(rows), 0), np.float32)
        for c in range(len(self.categories)):
            use = np.isin(self.ids, picks[c])
            z = np.concatenate([x[:, use], earlier], axis=1)
            y = labels[:, c].astype(np.float32)
            w, b = _logistic(z, y)
            self.weights[use, c], self.given[c, :c], self.bias[c] = w[:use.sum()], w[use.sum():], b
            out = np.zeros(len(rows), np.float32)
            for k in range(K):
                held = folds == k
                wk, bk = _logistic(z[~held], y[~held])
                out[held] = _sigmoid(z[held] @ wk + bk)
            earlier = np.concatenate([earlier, out[:, None]], axis=1)
        return self


def _sigmoid(a):
    return 1 / (1 + np.exp(-np.clip(a, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    w = np.zeros(x.shape[1], np.float32)
    if not len(y) or y.min() == y.max():
        return w, float(np.clip(40 * (y.mean() if len(y) else 0) - 20, -20, 20))
    b, rate = np.float32(np.log(y.mean() / (1 - y.mean()))), RATE
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, STEPS + 1):
        d = (_sigmoid(x @ w + b) - y) / len(y)
        g, gb = x.T @ d + L2 * w, d.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        fix = rate * np.sqrt(1 - 0.99 ** t) / (1 - 0.9 ** t)
        w = w - fix * m / (np.sqrt(v) + 1e-8)
        b = b - fix * mb / (np.sqrt(vb) + 1e-8)
    return w, float(b)


def _docs_with(of: np.ndarray, flat: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labelled positive and negative texts that hold each feature."""
    pair = np.unique(of.astype(np.int64) << BITS | flat)
    f, r = pair & ((1 << BITS) - 1), pair >> BITS
    return tuple(np.bincount(f[y[r] == v], minlength=1 << BITS) for v in (1, 0))


def _select(of: np.ndarray, flat: np.ndarray, y: np.ndarray) -> np.ndarray:
    a, b = _docs_with(of, flat, y)
    na, nb = max(1, int((y == 1).sum())), max(1, int((y == 0).sum()))
    ra, rb = (a + 0.5) / (na + 1), (b + 0.5) / (nb + 1)
    z = (np.log(ra / (1 - ra)) - np.log(rb / (1 - rb))) / np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    z[a + b < MARKER_DOCS] = 0
    top = np.argsort(-np.abs(z), kind="stable")[:SELECT]
    return np.sort(top[np.abs(z[top]) > 3])


def derive(rows: list[np.ndarray], kinds: list[np.ndarray], toxic: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Categories before 'toxic' from the markers of the labelled positives (``kinds``: 0 word, 1 prefix, per feature)."""
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    flat, kind = np.concatenate(rows), np.concatenate(kinds)
    a, b = _docs_with(of, flat, toxic)
    marker = (a >= MARKER_DOCS) & (a >= 20 * b)
    hit = marker[flat]
    count = [np.bincount(of[hit & (kind == k)], minlength=len(rows)) for k in (0, 1)]
    t = toxic == 1
    return (["marked", "coined", "dense", "toxic"],
            np.stack([t & (count[0] > 0), t & (count[1] > count[0]), t & (count[0] + count[1] >= 3), t], axis=1).astype(int))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feature ids and kinds of each labelled text, packed."""
    for part in slices(batches):
        names, row, word = _words(part.column("text"))
        feats = [_features(w) for w in names]
        out, kinds = [], []
        cuts = np.searchsorted(row, np.arange(part.num_rows + 1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            own = [feats[w] for w in word[a:b].tolist()]
            out.append(np.array([f for fs in own for f in fs], np.int32).tobytes())
            kinds.append(bytes(min(i, 1) for fs in own for i in range(len(fs))))
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), pa.array(out, pa.binary()),
                                          pa.array(kinds, pa.binary())], names=["doc_id", "toxic", "features", "kinds"])


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Chain | None:
    rows = labels.where((fold(F.col("doc_id"), FOLDS) != 0) & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    rows = rows.select(F.col("doc_id").cast("long").alias("__id"), F.col("toxic").cast("int").alias("toxic")).orderBy(
        F.xxhash64("doc_id"), "doc_id", "toxic").limit(train_rows)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample = slim.join(F.broadcast(rows), F.col("doc_id") == F.col("__id")).select("doc_id", "toxic", "text")
    seen = sample.mapInArrow(_rows, "doc_id long, toxic int, features binary, kinds binary")
    seen = seen.orderBy("doc_id", "toxic", "features").limit(2 * train_rows).collect()
    if not seen:
        return None
    feats = [np.frombuffer(r["features"], np.int32).astype(np.int64) for r in seen]
    kinds = [np.frombuffer(r["kinds"], np.uint8) for r in seen]
    names, y = derive(feats, kinds, np.array([r["toxic"] for r in seen]))
    return Chain(names).fit(feats, y)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        slot = {int(f): i for i, f in enumerate(chain.ids)}
        zero = np.zeros(len(chain.categories))
        for part in slices(batches):
            names, row, word = _words(part.column("text"))
            w = np.zeros((len(names), len(zero)))
            for i, name in enumerate(names):
                own = [slot[f] for f in _features(name) if f in slot]
                if own:
                    w[i] = chain.weights[own].sum(axis=0)
            some = np.flatnonzero(w.any(axis=1)[word]) if len(word) else np.zeros(0, np.int64)
            sums = np.stack([np.bincount(row[some], w[word[some], c], part.num_rows) for c in range(len(zero))], axis=1).astype(float)
            p = chain.probabilities(sums)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(p[:, c]) for c in range(len(zero)))],
                                             names=["doc_id", *(f"p_{c}" for c in chain.categories)])
    return run


def score(docs: DataFrame, chain: Chain | None) -> DataFrame:
    """doc_id and a probability per category (``p_<category>``) of every row; no shuffle."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if chain is None:
        return slim.select("doc_id", F.lit(0.0).alias("p_toxic"))
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    return slim.mapInArrow(_score(shared), "doc_id long, " + ", ".join(f"p_{c} double" for c in chain.categories))
