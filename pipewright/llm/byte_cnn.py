"""Byte-level convolutional classifier in numpy.

A text is cut into windows of ``length`` bytes, ``step`` apart, that cover it
whole (the last one padded with zeros). Per window: byte embeddings, filters
of several widths, the maximum of each filter over the window, an optional
hidden layer, class logits. A text's logits are the mean over its windows; a
softmax gives its probabilities.

Training (Adam on the softmax loss) sees at most ``TRAIN_WINDOWS`` windows of a
text, spread evenly over it, of a bounded number of texts; prediction sees
every window of every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pipewright.llm.common import slices

TRAIN_WINDOWS = 6
BATCH = 64
MIN_STEPS = 400


def window_starts(size: int, length: int, step: int) -> np.ndarray:
    """Starts of the windows that cover ``size`` bytes, one at least."""
    return np.arange(max(1, -(-(size - length) // step) + 1)) * step


class ByteCnn:
    def __init__(self, classes: list, length: int, step: int, widths: tuple[int, ...], filters: int,
                 dim: int = 8, hidden: int = 0, seed: int = 7):
        self.classes, self.length, self.step, self.widths, self.hidden = classes, length, step, widths, hidden
        rng = np.random.default_rng(seed)
        draw = lambda *s, fan: rng.normal(0, np.sqrt(2 / fan), s).astype(np.float32)
        self.p = {"E": draw(256, dim, fan=2 * dim)}
        for w in widths:
            self.p[f"W{w}"] = draw(w * dim, filters, fan=w * dim)
            self.p[f"b{w}"] = np.zeros(filters, np.float32)
        top = filters * len(widths)
        if hidden:
            self.p["U"], self.p["u"] = draw(top, hidden, fan=top), np.zeros(hidden, np.float32)
            top = hidden
        self.p["V"], self.p["v"] = draw(top, len(classes), fan=top) * 0.3, np.zeros(len(classes), np.float32)
        self.p["E"][0] = 0

    def _pooled(self, x: np.ndarray) -> np.ndarray:
        """(windows, filters) maxima. A filter's products for starts p, p + w, ... are one product of reshaped rows."""
        n, length = x.shape
        emb = self.p["E"][x.ravel()]
        dim, out = emb.shape[1], []
        for w in self.widths:
            W = self.p[f"W{w}"]
            y = np.empty((n * length, W.shape[1]), np.float32)
            for p in range(w):
                k = (n * length - p) // w
                y[p:p + w * k:w] = emb[p:p + w * k].reshape(k, w * dim) @ W
            out.append(y.reshape(n, length, -1)[:, :length - w + 1].max(axis=1) + self.p[f"b{w}"])
        return np.maximum(np.concatenate(out, axis=1), 0)

    def window_logits(self, x: np.ndarray) -> np.ndarray:
        z = self._pooled(x)
        if self.hidden:
            z = np.maximum(z @ self.p["U"] + self.p["u"], 0)
        return z @ self.p["V"] + self.p["v"]

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probabilities of the texts data[offsets[i]:offsets[i + 1]]."""
        n = len(offsets) - 1
        starts = [window_starts(int(s), self.length, self.step) for s in np.diff(offsets)]
        of = np.repeat(np.arange(n), [len(s) for s in starts])
        at = np.concatenate(starts) + offsets[of] if n else np.zeros(0, np.int64)
        total = np.zeros((n, len(self.classes)), np.float64)
        span = np.arange(self.length)
        for i in range(0, len(at), BATCH):
            idx = at[i:i + BATCH, None] + span
            inside = idx < offsets[of[i:i + BATCH] + 1][:, None]
            x = np.where(inside, data[np.minimum(idx, max(0, len(data) - 1))], 0) if len(data) else np.zeros(idx.shape, np.uint8)
            np.add.at(total, of[i:i + BATCH], self.window_logits(x))
        return _softmax(total / np.bincount(of, minlength=n)[:, None])

    def fit(self, windows: list[bytes], labels: list[int], epochs: int, rate: float = 2e-3, seed: int = 11) -> ByteCnn:
        """``windows``: the concatenated windows of each text."""
        x = [np.frombuffer(w, np.uint8).reshape(-1, self.length) for w in windows]
        y = np.array(labels)
        rng = np.random.default_rng(seed)
        m = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        epochs = max(epochs, -(-MIN_STEPS // -(-len(x) // BATCH)))  # small samples are gone over more often
        t, total = 0, epochs * -(-len(x) // BATCH)
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(order), BATCH):
                sel = order[i:i + BATCH]
                g = self._gradients(np.concatenate([x[j] for j in sel]), [len(x[j]) for j in sel], y[sel])
                t += 1
                lr = rate * np.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t) * (1 - t / (total + 1))
                for k, v in g.items():
                    a, b = m[k]
                    a += 0.1 * (v - a)
                    b += 0.001 * (v * v - b)
                    self.p[k] -= lr * a / (np.sqrt(b) + 1e-8)
                self.p["E"][0] = 0
        return self

    def _gradients(self, x: np.ndarray, counts: list[int], y: np.ndarray) -> dict[str, np.ndarray]:
        n, length = x.shape
        emb = self.p["E"][x]
        dim = emb.shape[2]
        kept, z = [], []
        for w in self.widths:
            cols = np.lib.stride_tricks.sliding_window_view(emb, (w, dim), axis=(1, 2))[:, :, 0].reshape(n, length - w + 1, w * dim)
            a = cols @ self.p[f"W{w}"]
            arg = a.argmax(axis=1)
            z.append(np.take_along_axis(a, arg[:, None], axis=1)[:, 0] + self.p[f"b{w}"])
            kept.append((w, arg, cols[np.arange(n)[:, None], arg]))
        z = np.concatenate(z, axis=1)
        r = np.maximum(z, 0)
        h = np.maximum(r @ self.p["U"] + self.p["u"], 0) if self.hidden else r
        of = np.repeat(np.arange(len(counts)), counts)
        size = np.array(counts, np.float32)
        logits = h @ self.p["V"] + self.p["v"]
        mean = np.stack([np.bincount(of, logits[:, c], len(counts)) for c in range(logits.shape[1])], axis=1) / size[:, None]
        d = _softmax(mean)
        d[np.arange(len(y)), y] -= 1
        d = (d / (len(y) * size[:, None]))[of].astype(np.float32)
        g = {"V": h.T @ d, "v": d.sum(axis=0)}
        dh = d @ self.p["V"].T
        if self.hidden:
            dh = dh * (h > 0)
            g["U"], g["u"] = r.T @ dh, dh.sum(axis=0)
            dh = dh @ self.p["U"].T
        dz = dh * (z > 0)
        dE = np.zeros_like(self.p["E"])
        at = 0
        for w, arg, cols in kept:
            W = self.p[f"W{w}"]
            part = dz[:, at:at + W.shape[1]]
            at += W.shape[1]
            g[f"W{w}"], g[f"b{w}"] = np.einsum("nfk,nf->kf", cols, part), part.sum(axis=0)
            back = (part[:, :, None] * W.T[None]).reshape(-1, dim)
            which = x[np.arange(n)[:, None, None], arg[:, :, None] + np.arange(w)].ravel()
            for c in range(dim):
                dE[:, c] += np.bincount(which, back[:, c], 256)
        g["E"] = dE
        return g


def _softmax(a: np.ndarray) -> np.ndarray:
    e = np.exp(a - a.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def training_windows(text: Column, sample: DataFrame, length: int, step: int) -> DataFrame:
    """``sample`` (label and others) with the training windows of its ``text``, concatenated, in ``windows``."""
    others = [c for c in sample.columns if c != "text"]
    schema = sample.select(*others, F.lit(b"").alias("windows")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out = []
            for raw in part.column("text").cast(pa.binary()).to_pylist():
                raw = raw or b""
                starts = window_starts(len(raw), length, step)
                pick = np.unique(np.linspace(0, len(starts) - 1, TRAIN_WINDOWS).astype(int))
                out.append(b"".join(raw[s:s + length].ljust(length, b"\0") for s in starts[pick].tolist()))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in others), pa.array(out, pa.binary())],
                                             names=[*others, "windows"])
    return sample.mapInArrow(run, schema)


def scorer(shared, names: list[str]):
    """Adds ``probs`` (one per class) to rows with a ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for part in slices(batches):
            text = pc.fill_null(part.column("text"), "").cast(pa.large_binary())
            _, off, data = text.buffers()
            off = np.frombuffer(off, np.int64, len(text) + 1, 8 * text.offset)
            p = net.predict(np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), off)
            probs = pa.ListArray.from_arrays(np.arange(len(p) + 1, dtype=np.int32) * p.shape[1], pa.array(p.ravel()))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names if c != "text"), probs],
                                             names=[*(c for c in names if c != "text"), "probs"])
    return run
