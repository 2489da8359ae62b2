"""Line dedup through a sharded minimal perfect hash.

A line's key is the line without ASCII whitespace at its ends, A-Z lowered.
Keys of at least ``min_chars`` code points found in at least ``min_docs``
documents lose all their lines except in the largest doc_id that holds them.

1. Statistics: every task reduces its batches to (key hash of 128 bits, rows
   holding it, largest doc_id); one shuffle sums them up.
2. Index: the keys that pass go to shards by hash. Each shard becomes one row:
   a minimal perfect hash plus arrays of fingerprints, counts and holders.
3. Probe: each batch of documents sends one packed row to each shard it needs
   (distinct keys, and the ids of the documents that hold them). A shard's row
   sorts before the probes sent to it, so a task streams: it holds one shard's
   arrays and one batch of probes, whatever their number. Shards are
   replicated ``SALTS`` times, which splits the probes of a very common line.
4. What has to go is packed per doc_id and joined to the documents.

No line is ever joined with another line. Every row of the input counts as a
document of its own.

Edge cases: null or empty text is one empty line; a null doc_id holds a line
but is never the largest, and a line whose holders all lack an id stays; rows
that share the largest doc_id all keep the line; an empty table gives an empty
result; extra columns pass through unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pipewright.llm.common import partitions, slices
from pipewright.llm.mphf import Mphf

MIN_CHARS, MIN_DOCS = 40, 5
SALTS = 4
STATS = "hi long, lo long, n long, holder long"
PROBES = "shard int, salt int, kind int, keys binary, runs binary, ids binary, texts binary"
DROPS = "doc_id long, text_key long, keys binary"


def _lines(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All lines of the texts, flat, and the offsets of each text's lines."""
    lists = pc.split_pattern(pc.fill_null(text, ""), "\n")
    return lists.flatten(), np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)]


def _keys(lines: pa.Array, min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the lines whose key is long enough, and the keys' 128-bit hashes as rows of (hi, lo)."""
    key = pc.ascii_lower(pc.ascii_trim(lines, characters=" \t\n\x0b\x0c\r"))
    at = np.flatnonzero(pc.greater_equal(pc.utf8_length(key), min_chars).to_numpy(zero_copy_only=False))
    digest = xxhash.xxh3_128_digest
    raw = b"".join(digest(v) for v in key.take(pa.array(at)).cast(pa.binary()).to_pylist())
    return at, np.frombuffer(raw, np.uint64).reshape(-1, 2)


def _pairs(part: pa.RecordBatch, min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (key, row) pairs of a slice: (n, 2) keys and the row of each, sorted by key, then row."""
    lines, ends = _lines(part.column("text"))
    at, keys = _keys(lines, min_chars)
    rows = np.searchsorted(ends, at, side="right") - 1
    order = np.lexsort((rows, keys[:, 1], keys[:, 0]))
    keys, rows = keys[order], rows[order]
    new = np.r_[True, (keys[1:] != keys[:-1]).any(axis=1) | (rows[1:] != rows[:-1])][:len(rows)]
    return keys[new], rows[new]


def _starts(keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)][:len(keys)])


def _stats(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            keys, rows = _pairs(part, min_chars)
            if not len(keys):
                continue
            starts = _starts(keys)
            ids = part.column("doc_id")
            null = ids.is_null().to_numpy(zero_copy_only=False)
            low = np.iinfo(np.int64).min
            idv = np.where(null, low, pc.fill_null(ids, 0).to_numpy(zero_copy_only=False))[rows]
            best = np.maximum.reduceat(idv, starts)
            some = np.maximum.reduceat(~null[rows], starts)
            first = keys[starts].view(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(first[:, 0]), pa.array(first[:, 1]),
                pa.array(np.diff(np.r_[starts, len(rows)]).astype(np.int64)), pa.array(best, mask=~some)],
                names=["hi", "lo", "n", "holder"])
    return run


def _build(table: pa.Table) -> pa.Table:
    """One shard: perfect hash, fingerprints, counts and holders, by slot."""
    hi, lo, n, holder = (table.column(c).to_numpy() for c in ("hi", "lo", "n", "holder"))
    lo = lo.view(np.uint64)
    f = Mphf.build(lo)
    slot = f.slots(lo)
    place = np.empty(len(slot), np.int64)
    place[slot] = np.arange(len(slot))
    return pa.table({
        "shard": table.column("shard").slice(0, 1), "mphf": pa.array([f.dump()], pa.binary()),
        "fingerprint": pa.array([hi[place].tobytes()], pa.binary()),
        "counts": pa.array([np.minimum(n[place], 2**32 - 1).astype(np.uint32).tobytes()], pa.binary()),
        "holders": pa.array([holder[place].tobytes()], pa.binary())})


INDEX = "shard int, mphf binary, fingerprint binary, counts binary, holders binary"


def _send(min_chars: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        salt = TaskContext.get().partitionId()
        for part in slices(batches):
            keys, rows = _pairs(part, min_chars)
            if not len(keys):
                continue
            salt += 1
            ids, text_key = (part.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("id0", "text_key"))
            shard = (keys[:, 0].view(np.int64) % shards).astype(np.int32)
            order = np.argsort(shard, kind="stable")
            cuts = np.flatnonzero(np.r_[True, np.diff(shard[order]) != 0])
            out = []
            for a, b in zip(cuts, np.r_[cuts[1:], len(order)]):
                sel = order[a:b]
                starts = _starts(keys[sel])
                runs = np.diff(np.r_[starts, len(sel)]).astype(np.uint32)
                out.append((int(shard[sel[0]]), salt % SALTS, 1, keys[sel][starts].tobytes(), runs.tobytes(),
                            ids[rows[sel]].tobytes(), text_key[rows[sel]].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out), (pa.int32(),) * 3 + (pa.binary(),) * 4)],
                names=["shard", "salt", "kind", "keys", "runs", "ids", "texts"])
    return run


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's arrays come first (kind 0), then what was sent to it."""
    held = None
    for batch in batches:
        for i in range(batch.num_rows):
            shard, kind = batch.column("shard")[i].as_py(), batch.column("kind")[i].as_py()
            keys, runs, ids, texts = (batch.column(c)[i].as_py() for c in ("keys", "runs", "ids", "texts"))
            if kind == 0:
                held = (shard, Mphf.load(keys), np.frombuffer(runs, np.int64), np.frombuffer(texts, np.int64))
                continue
            if held is None or held[0] != shard:
                continue  # a shard without keys
            _, f, fingerprint, holders = held
            k = np.frombuffer(keys, np.uint64).reshape(-1, 2)
            slot = f.slots(k[:, 1])
            hit = (slot >= 0) & (fingerprint[slot] == k[:, 0].view(np.int64))
            if not hit.any():
                continue
            run = np.frombuffer(runs, np.uint32).astype(np.int64)
            of = np.repeat(np.arange(len(k)), run)
            d, t = np.frombuffer(ids, np.int64), np.frombuffer(texts, np.int64)
            # a row goes without the line unless it has the holder's id; text_key is 0 exactly for rows with an id
            gone = hit[of] & ~((d == holders[slot[of]]) & (t == 0))
            of, d, t = of[gone], d[gone], t[gone]
            if not len(of):
                continue
            order = np.lexsort((t, d))
            of, d, t = of[order], d[order], t[order]
            starts = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (t[1:] != t[:-1])])
            packed = [k[of[a:b]].tobytes() for a, b in zip(starts, np.r_[starts[1:], len(of)])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(d[starts]), pa.array(t[starts]), pa.array(packed, pa.binary())],
                names=["doc_id", "text_key", "keys"])


def _apply(min_chars: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            text = pc.fill_null(part.column("text"), "")
            lines, ends = _lines(text)
            n_lines = np.diff(ends)
            dropped = np.zeros(part.num_rows, np.int64)
            touched = np.flatnonzero(pc.is_valid(part.column("drops")).to_numpy(zero_copy_only=False))
            kept = {}
            for i in touched.tolist():
                own = lines.slice(int(ends[i]), int(n_lines[i]))
                at, keys = _keys(own, min_chars)
                gone = {blob[j:j + 16] for blob in part.column("drops")[i].as_py() for j in range(0, len(blob), 16)}
                stay = np.ones(len(own), bool)
                stay[at] = [row.tobytes() not in gone for row in keys]
                dropped[i] = len(own) - int(stay.sum())
                kept[i] = "\n".join(own.filter(pa.array(stay)).to_pylist())
            if kept:
                values = text.to_pylist()
                for i, v in kept.items():
                    values[i] = v
                text = pa.array(values, pa.string())
            yield pa.RecordBatch.from_arrays([part.column("row"), text, pa.array(n_lines), pa.array(dropped)], names=names)
    return run


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``row`` (a struct of all columns but text), ``text`` without the lines that go, ``n_lines``, ``n_dropped``."""
    spark = docs.sparkSession
    width = partitions(spark)
    shards = 4 * width
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    stats = slim.mapInArrow(_stats(min_chars), STATS)
    found = stats.groupBy("hi", "lo").agg(F.sum("n").alias("n"), F.max("holder").alias("holder"))
    found = found.where((F.col("n") >= min_docs) & F.col("holder").isNotNull())
    found = found.withColumn("shard", F.pmod("hi", F.lit(shards)).cast("int"))
    index = found.groupBy("shard").applyInArrow(_build, INDEX)

    # rows without an id are told apart by their text
    id0 = F.coalesce(F.col("doc_id").cast("long"), F.lit(0))
    text_key = F.when(F.col("doc_id").isNull(), F.xxhash64("text").bitwiseOR(F.lit(1))).otherwise(F.lit(0))
    keyed = docs.select(id0.alias("id0"), text_key.cast("long").alias("text_key"), "text")
    sent = keyed.mapInArrow(_send(min_chars, shards), PROBES)
    arrays = index.select("shard", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
                          F.lit(0).alias("kind"), F.col("mphf").alias("keys"), F.col("fingerprint").alias("runs"),
                          F.col("counts").alias("ids"), F.col("holders").alias("texts"))
    meet = arrays.unionByName(sent).repartition(width, "shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    drops = meet.mapInArrow(_probe, DROPS).groupBy("doc_id", "text_key").agg(F.collect_list("keys").alias("drops"))

    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), "text",
                       id0.alias("__id"), text_key.cast("long").alias("__t"))
    joined = rows.join(drops, (rows["__id"] == drops["doc_id"]) & (rows["__t"] == drops["text_key"]), "left")
    out = T.StructType([rows.schema["row"], T.StructField("text", T.StringType()),
                        T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return joined.select("row", "text", "drops").mapInArrow(_apply(min_chars, out.names), out)


def apply_line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the same rows and columns, the repeated lines removed from ``text`` (null text becomes '')."""
    d = line_dedup(docs, min_chars, min_docs)
    return d.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
