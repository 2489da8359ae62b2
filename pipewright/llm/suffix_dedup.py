"""Suffix-array dedup: every byte covered by a repeated string of ``MIN_BYTES`` bytes goes.

Texts are UTF-8 bytes. The suffix array is sparse: of each ``MIN_BYTES`` bytes in a
row it holds the suffix at the smallest hash of ``GRAM`` bytes among them (the
leftmost of equals). The choice depends on those bytes alone, so equal strings of
``MIN_BYTES`` bytes have a suffix at the same place in them, and the array needs about
one suffix in 70 bytes.

1. Suffixes are counted by the hash of their first ``GRAM`` bytes. Those alone with it
   are no part of a repeat and go.
2. The others meet their hash's bucket. Suffixes that agree in the whole context (all
   the bytes that a string of ``MIN_BYTES`` around the gram can hold) are one member with
   a count; they repeat as far as the context goes. Only one member of each different
   context, in buckets with several, has its bytes cut from its text.
3. Spark sorts the members by bucket and right bytes: the suffix array in pieces, each
   bucket a subtree. Per bucket a stack scan over the common prefixes gives the interval
   tree, and the sets of equal left extension in its nodes the maximal repeats with all
   their members (``suffix_array.repeats``). They are maximal within the context; a longer
   repeat is found as one group for each of its suffixes.
4. A bucket of more than ``BUCKET`` members is split before: a member takes part in one
   bucket for each of ``PARTS`` ranges of places in the string, keyed by all bytes that
   every string of the range holds; if that is still too large, in one for each place. There the key is
   the whole string, so such a bucket is one group without a scan. Only places in strings that
   chose the suffix count: every string has one suffix that stands for it. No task holds more than
   ``BUCKET`` members, and no pairs are formed.
5. What each suffix covers is packed per document and joined to the texts.

Edge cases: null or empty text has no bytes and gives b''; texts under ``MIN_BYTES`` stay;
rows without id are told apart by their text; rows equal in id and text are
repeats of each other and are treated alike; an empty table gives an empty result; extra columns pass
through whatever their names. Kept bytes may cut a character, so they are binary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pipewright.llm.common import mix, slices, store
from pipewright.llm.suffix_array import prefixes, repeats

MIN_BYTES, GRAM = 200, 64
BUCKET, PARTS = 4096, 8
SPLIT_ROWS = 10_000  # rows that a task holds of a bucket's split
BLOCK = 1 << 17  # bytes hashed at once, whatever a text's length
WHOLE = 255  # a cover's length: as far as the context goes
_SEED = np.random.default_rng(20250117).integers(0, 2**64 - 1, 257, dtype=np.uint64) | np.uint64(1)
_BYTE, _BASE = _SEED[:256], _SEED[256]
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(n, base, np.uint64)], dtype=np.uint64)


class _Hash:
    """Hashes of any range of a block of bytes, from one prefix sum."""

    powers = inverses = np.zeros(0, np.uint64)

    def __init__(self, block: np.ndarray):
        n = len(block)
        if len(_Hash.powers) <= n:
            _Hash.powers, _Hash.inverses = _powers(_BASE, n), _powers(_INVERSE, n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[block] * self.powers[:n], dtype=np.uint64, out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.inverses[start]

    def grams(self, k: int) -> np.ndarray:
        return (self.sums[k:] - self.sums[:-k]) * self.inverses[:len(self.sums) - k]


def _smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest key (leftmost of equal ones) in each window of ``width`` keys."""
    mask = np.uint64(2 * BLOCK - 1)
    m = (keys & ~mask) | np.arange(len(keys), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    if span < width:
        m = np.minimum(m[:len(m) - (width - span)], m[width - span:])
    return (m & mask).astype(np.int64)


def suffixes(data: np.ndarray, ends: np.ndarray, size: int = MIN_BYTES, gram: int = GRAM,
             block: int = BLOCK) -> Iterator[tuple[np.ndarray, ...]]:
    """Chosen suffixes of the texts in ``data`` (text i: ``ends[i]`` to ``ends[i + 1]``), block by block:
    text, place in it, hash of the first ``gram`` bytes, hash of the whole context."""
    n, last = len(data), -1
    for start in range(0, max(n - size + 1, 0), block):
        stop = min(start + block, n - size + 1)  # starts of strings
        a, b = max(0, start - size), min(n, stop + 2 * size)
        h = _Hash(data[a:b])
        keys = mix(h.grams(gram))[start - a:stop - a + size - gram]
        inside = np.zeros(stop - start + 1, np.int64)  # strings that lie in one text
        lo, hi = np.clip(ends[:-1], start, stop) - start, np.clip(ends[1:] - size + 1, start, stop) - start
        some = hi > lo
        np.add.at(inside, lo[some], 1)
        np.add.at(inside, hi[some], -1)
        chosen = _smallest(keys, size - gram + 1)[np.cumsum(inside[:-1]) > 0]
        if not len(chosen):
            continue
        place = np.unique(chosen) + start
        place = place[place > last]  # the last block's strings may have chosen the same
        if not len(place):
            continue
        last = int(place[-1])
        text = np.searchsorted(ends, place, side="right") - 1
        x, y = np.maximum(ends[text], place - (size - gram)), np.minimum(ends[text + 1], place + size)
        context = mix(h.of(x - a, y - a) + (place - x).astype(np.uint64) * _SEED[0] + (y - place).astype(np.uint64) * _SEED[1])
        yield text, place - ends[text], mix(h.of(place - a, place - a + gram)), context


def _bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts (null: none) and where each begins."""
    raw = pc.fill_null(text, "").cast(pa.large_binary())
    ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    return data, ends - ends[0]


def _emit(only_keys: bool, size: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            data, ends = _bytes(part.column("text"))
            if only_keys:
                for _, _, key, _ in suffixes(data, ends, size, gram):
                    key, n = np.unique(key, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["key", "n"])
                continue
            id0, low = (part.column(c).to_numpy() for c in ("id0", "low"))
            for text, place, key, context in suffixes(data, ends, size, gram):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (key.view(np.int64), context.view(np.int64), id0[text], low[text] << 32 | place)],
                    names=["key", "context", "id0", "at"])
    return run


MEMBERS = "key long, context long, left binary, right binary"


def _cut(size: int, gram: int):
    """The bytes around the asked suffixes of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            keys, contexts, left, right = [], [], [], []
            for text, asked in zip(part.column("text").cast(pa.binary()).to_pylist(), part.column("asked").to_pylist()):
                for a in asked:
                    place = a["at"] & 0xFFFFFFFF
                    keys.append(a["key"])
                    contexts.append(a["context"])
                    left.append(text[max(0, place - (size - gram)):place])
                    right.append(text[place:place + size])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(contexts, pa.int64()),
                                              pa.array(left, pa.binary()), pa.array(right, pa.binary())],
                                             names=["key", "context", "left", "right"])
    return run


def _parts(size: int, gram: int, parts: int) -> list[tuple[int, int]]:
    """Ranges of the places that a suffix can have in a string."""
    cuts = np.linspace(0, size - gram + 1, parts + 1).round().astype(int).tolist()
    return [(a, b - 1) for a, b in zip(cuts, cuts[1:]) if b > a]


def _leads(left: bytes, right: bytes, size: int, gram: int) -> set[int]:
    """Places that the suffix has in those strings whose chosen suffix it is."""
    both = np.frombuffer(left + right, np.uint8)
    if len(both) < size:
        return set()
    chosen = _smallest(mix(_Hash(both).grams(gram)), size - gram + 1)
    return set((len(left) - np.flatnonzero(chosen == len(left))).tolist())


def _split(size: int, gram: int, ranges: list[tuple[int, int]], names: list[str]):
    """Each member once for every range with a string that chose it: the bucket's new key is what all strings of the range hold of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for part in slices(batches, "right"):
            row, bucket, lead = [], [], []

            def pack():
                take = pa.array(row, pa.int64())
                made = {"bucket": pa.array(np.array(bucket, np.uint64).view(np.int64)), "lead": pa.array(lead, pa.int32())}
                return pa.RecordBatch.from_arrays([made[c] if c in made else part.column(c).take(take) for c in names], names=names)

            for i, (left, right) in enumerate(zip(part.column("left").to_pylist(), part.column("right").to_pylist())):
                own = _leads(left, right, size, gram)
                for lo, hi in ranges:
                    if not own.isdisjoint(range(lo, hi + 1)):
                        row.append(i)
                        bucket.append(digest(left[len(left) - lo:] + right[:size - hi], seed=hi + 1))
                        lead.append(hi)
                if len(row) > SPLIT_ROWS:
                    yield pack()
                    row, bucket, lead = [], [], []
            if row:
                yield pack()
    return run


def _scan(size: int, gram: int, groups: bool):
    """Members sorted by bucket and right bytes -> what their maximal repeats cover, or (``groups``) the repeats themselves."""
    def bucket(*columns):
        # rows equal in id and text give a member more than once
        keys, contexts, left, right = zip(*{r[:2]: r for r in zip(*columns)}.values())
        common = prefixes(right, size).tolist()
        best = [(0, 0)] * len(left)
        for lead, tail, members in repeats(left, common, size, gram):
            if groups:
                string = left[members[0]][len(left[members[0]]) - lead:] + right[members[0]][:tail]
                # a suffix chosen by strings around this one only may not be chosen at every occurrence
                if _leads(string[:lead], string[lead:], size, gram).isdisjoint(range(size - tail, lead + 1)):
                    continue
                name = xxhash.xxh3_128_digest(string)
            for m in members:
                if groups:
                    yield keys[m], contexts[m], lead, tail, name
                else:
                    best[m] = max(best[m][0], lead), max(best[m][1], tail)
        if not groups:
            for m, (lead, tail) in enumerate(best):
                if lead + tail:
                    yield keys[m], contexts[m], lead, tail

    names = ["key", "context", "lead", "tail", "repeat"][:5 if groups else 4]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now, out = ([], [], [], []), None, []

        def pack():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

        for batch in batches:
            ids = batch.column("bucket").to_numpy()
            starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]][:len(ids)])
            cols = [batch.column(c).to_pylist() for c in ("key", "context", "left", "right")]
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)]):
                if now != ids[a]:
                    if len(held[0]) > 1:
                        out += bucket(*held)
                    held, now = ([], [], [], []), ids[a]
                for h, c in zip(held, cols):
                    h += c[a:b]
            if len(out) > 20_000:
                yield pack()
                out = []
        if len(held[0]) > 1:
            out += bucket(*held)
        if out:
            yield pack()
    return run


def _keyed(docs: DataFrame) -> tuple[Column, Column]:
    return (F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("id0"),
            F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF)).alias("low"))


def _found(docs: DataFrame, size: int, gram: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Suffixes that share their gram; members (different contexts, counted); the bytes of those in buckets with several. All written out."""
    id0, low = _keyed(docs)
    slim = docs.where(F.octet_length("text") >= size).select(id0, low, "text")
    several = slim.mapInArrow(_emit(True, size, gram), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    several = store(several.where("n > 1").select(F.col("key").alias("__key")))
    every = slim.mapInArrow(_emit(False, size, gram), "key long, context long, id0 long, at long")
    shared = store(every.join(several, F.col("key") == F.col("__key")).select("key", "context", "id0", "at"))

    members = store(shared.groupBy("key", "context").agg(F.min(F.struct("id0", "at")).alias("one"), F.count("*").alias("n")))
    # written out, so that a gram with a large part of all contexts is a large side that Spark can split
    mixed = store(members.groupBy(F.col("key").alias("__key")).count().where("count > 1").select("__key"))
    asked = members.join(mixed, F.col("key") == F.col("__key")).groupBy(
        F.col("one.id0").alias("__i"), F.shiftrightunsigned("one.at", 32).alias("__l")).agg(
        F.collect_list(F.struct("key", "context", F.col("one.at").alias("at"))).alias("asked"))
    cut = asked.join(slim, (F.col("__i") == F.col("id0")) & (F.col("__l") == F.col("low")))
    return shared, members, store(cut.select("text", "asked").mapInArrow(_cut(size, gram), MEMBERS))


def _buckets(members: DataFrame, size: int, gram: int, most: int, parts: int) -> tuple[DataFrame, DataFrame]:
    """Members with their buckets, none over ``most`` members; and what the buckets of equal strings cover."""
    def over(df: DataFrame, by: str) -> DataFrame:
        return store(df.groupBy(by).count().where(F.col("count") > most).select(F.col(by).alias("__by")))

    large = over(members, "key")
    is_large = F.col("key") == F.col("__by")
    small = members.join(large, is_large, "left_anti").withColumn("bucket", F.col("key"))
    ids, text = "key long, context long", "left binary, right binary"
    split = store(members.join(large, is_large, "left_semi").mapInArrow(
        _split(size, gram, _parts(size, gram, parts), ["key", "context", "left", "right", "bucket"]), f"{ids}, {text}, bucket long"))
    large2 = over(split, "bucket")
    is_large2 = F.col("bucket") == F.col("__by")
    small = small.unionByName(split.join(large2, is_large2, "left_anti"))
    rest = split.join(large2, is_large2, "left_semi").select("key", "context", "left", "right").distinct()
    single = store(rest.mapInArrow(_split(size, gram, [(i, i) for i in range(size - gram + 1)], ["key", "context", "bucket", "lead"]),
                                   f"{ids}, bucket long, lead int"))
    equal = single.groupBy(F.col("bucket").alias("__by")).count().where("count > 1").select("__by")
    return small, single.join(store(equal), is_large2, "left_semi").select(
        "key", "context", "bucket", "lead", (F.lit(size) - F.col("lead")).alias("tail"))


def covers(docs: DataFrame, size: int = MIN_BYTES, gram: int = GRAM, bucket: int = BUCKET, parts: int = PARTS) -> DataFrame:
    """What goes, per row (``__i``, ``__l``: its id and the low bits of its text's hash): packed place, bytes to the left, to the right."""
    shared, members, around = _found(docs, size, gram)
    small, equal = _buckets(around, size, gram, bucket, parts)
    schema = "key long, context long, lead int, tail int"
    scanned = small.repartition("bucket").sortWithinPartitions("bucket", "right").mapInArrow(_scan(size, gram, False), schema)
    cover = scanned.unionByName(equal.drop("bucket")).groupBy("key", "context").agg(F.max("lead").alias("lead"), F.max("tail").alias("tail"))
    twice = members.where("n > 1").select(
        "key", "context", F.lit(WHOLE).alias("lead"), F.lit(WHOLE).alias("tail"))
    best = cover.unionByName(twice).groupBy(F.col("key").alias("__key"), F.col("context").alias("__context")).agg(
        F.max("lead").alias("lead"), F.max("tail").alias("tail"))
    hit = shared.join(store(best), (F.col("key") == F.col("__key")) & (F.col("context") == F.col("__context")))
    packed = F.shiftleft(F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)), 16).bitwiseOR(
        F.col("lead") * F.lit(256) + F.col("tail"))
    return hit.groupBy(F.col("id0").alias("__i"), F.shiftrightunsigned("at", 32).alias("__l")).agg(F.collect_set(packed).alias("covers"))


def _apply(size: int, gram: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            kept, n_bytes, n_removed, n_spans = [], [], [], []
            for text, packed in zip(pc.fill_null(part.column("text"), "").cast(pa.binary()).to_pylist(), part.column("covers").to_pylist()):
                n, spans, gone = len(text), 0, 0
                if packed:
                    c = np.array(packed, np.int64)
                    place, lead, tail = c >> 16, c >> 8 & 255, c & 255
                    whole = lead == WHOLE
                    lead = np.where(whole, np.minimum(place, size - gram), lead)
                    tail = np.where(whole, np.minimum(n - place, size), tail)
                    some = lead + tail >= size
                    edge = np.zeros(n + 1, np.int64)
                    np.add.at(edge, (place - lead)[some], 1)
                    np.add.at(edge, (place + tail)[some], -1)
                    out = np.cumsum(edge[:-1]) > 0
                    gone, spans = int(out.sum()), int((np.diff(np.r_[False, out].astype(np.int8)) == 1).sum())
                    text = np.frombuffer(text, np.uint8)[~out].tobytes() if gone else text
                kept.append(text)
                n_bytes.append(n)
                n_removed.append(gone)
                n_spans.append(spans)
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(kept, pa.binary()), *(pa.array(x, pa.int64())
                                              for x in (n_bytes, n_removed, n_spans))], names=names)
    return run


def suffix_dedup(docs: DataFrame, size: int = MIN_BYTES, gram: int = GRAM, bucket: int = BUCKET, parts: int = PARTS) -> DataFrame:
    """``row`` (a struct of all columns but text), ``kept`` (binary), ``n_bytes``, ``n_removed``, ``n_spans``."""
    drops = covers(docs, size, gram, bucket, parts)
    id0, low = _keyed(docs)
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), "text", id0, low)
    joined = rows.join(drops, (rows["id0"] == drops["__i"]) & (rows["low"] == drops["__l"]), "left")
    out = T.StructType([rows.schema["row"], T.StructField("kept", T.BinaryType()),
                        *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans"))])
    return joined.select("row", "text", "covers").mapInArrow(_apply(size, gram, out.names), out)


def maximal_repeats(docs: DataFrame, size: int = MIN_BYTES, gram: int = GRAM, bucket: int = BUCKET, parts: int = PARTS) -> DataFrame:
    """Repeat groups with all their occurrences: ``repeat`` (hash of the string), ``n_bytes``, ``doc_id``, ``start``.

    Maximal within the context of a chosen suffix (see the module). Members with one
    common context are a group of its whole length. In a bucket too large for a scan
    the groups are the strings of ``size`` bytes themselves.
    """
    shared, members, around = _found(docs, size, gram)
    small, equal = _buckets(around, size, gram, bucket, parts)
    schema = "key long, context long, lead int, tail int, repeat binary"
    found = small.repartition("bucket").sortWithinPartitions("bucket", "right").mapInArrow(_scan(size, gram, True), schema)
    named = equal.select("key", "context", "lead", "tail", F.md5(F.concat_ws(":", "bucket", "lead").cast("binary")).cast("binary").alias("repeat"))
    found = found.unionByName(named).distinct()
    f = found.select(*[F.col(c).alias(f"__{c}") for c in found.columns])
    occurrences = shared.join(f, (F.col("key") == F.col("__key")) & (F.col("context") == F.col("__context"))).select(
        F.col("__repeat").alias("repeat"), (F.col("__lead") + F.col("__tail")).alias("n_bytes"), "id0",
        (F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)) - F.col("__lead")).alias("start"))
    return occurrences.select("repeat", F.col("n_bytes").cast("long").alias("n_bytes"),
                          F.when(F.col("id0") < 2**63 - 1, F.col("id0")).alias("doc_id"), "start").distinct()
