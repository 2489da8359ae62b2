"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pipewright.session import ensure_checkpoint_dir

WS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
# rows of one Arrow batch are worked on in slices of about this many text bytes (one row at least)
SLICE_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def partitions(spark: SparkSession) -> int:
    """Shuffle width of the session: every shard and bucket count is a multiple of it, so they grow with the setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files (lost executors cost no recomputation)."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        ensure_checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def store(df: DataFrame) -> DataFrame:
    """Like ``cut`` as a Parquet table in the same folder: compressed and column-pruned, for results with whole texts."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def fold(col: Column, mod: int) -> Column:
    """crc32 of the id's text, modulo ``mod`` (null ids: as the empty text)."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of bounded text size, in order, whole rows only."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size, dtype=np.int64) // SLICE_BYTES
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], n]):
            yield batch.slice(int(a), int(b - a))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (public splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_strings(values: pa.Array) -> np.ndarray:
    """64-bit hash of each string's UTF-8 bytes."""
    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(v) for v in values.cast(pa.binary()).to_pylist()), dtype=np.uint64, count=len(values))


def word_hashes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words (runs of non-whitespace, A-Z lowered) of each text as 64-bit hashes: (hashes, offsets); null: no words."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(text, "")))
    codes = lists.flatten().dictionary_encode()
    ends = np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)]
    idx = codes.indices.to_numpy(zero_copy_only=False)
    hashes = hash_strings(codes.dictionary)
    empty = np.array([v == "" for v in codes.dictionary.to_pylist()], dtype=bool)
    if empty.any():  # text edges give empty pieces, which are no words
        keep = ~empty[idx]
        ends = np.r_[0, np.cumsum(keep, dtype=np.int64)][ends]
        idx = idx[keep]
    return hashes[idx] if len(idx) else np.zeros(0, np.uint64), ends


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``k`` words; fewer words: the whole sequence as one; none: empty."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    k = min(k, n)
    acc = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + words[j:n - k + 1 + j])
    return np.unique(acc)
