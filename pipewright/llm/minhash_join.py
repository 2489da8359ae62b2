"""MinHash near-dedup by an inverted join on signature coordinates.

Documents with equal shingle sets form a class first (one row per class from
there on). A class is posted under each (coordinate, value) of the prefix of
its signature: two signatures of n coordinates that agree on at least t agree
on one of any n - t + 1, so the other coordinates need no posting. t lies
``SIGMAS`` standard deviations below the agreement expected at the similarity
threshold. Postings are kept apart by size class: set sizes of a linked pair differ
by at most the threshold, which is one step of the class scale, so a class is
posted under its own step and the next one up and meets every size it can be linked with.

1. Star pass: in each posting list every class meets the list's heaviest one,
   the class whose lists hold most others, which is the text that a group of
   copies comes from. Collisions are counted per pair; pairs whose full signatures agree on t
   coordinates and whose set sizes allow the threshold are confirmed on the
   full shingle sets. Links are merged into components.
2. Skip pass: a list whose classes all lie in one component has nothing to
   add and is skipped. In the others only pairs of different components are
   compared, on signatures in memory, in the list of the pair's first common
   prefix coordinate; those above t are confirmed on the full sets. A list with
   more than ``SPLIT`` such pairs is posted again under a further coordinate (a
   pair that has d common coordinates agrees on t - d later ones, so the same
   prefix argument holds), and again and again while it has more than ``LIST_ROWS``
   rows, as long as that leaves fewer pairs, which is counted without signatures first. What is left of more than ``LIST_ROWS`` rows is
   cut into blocks, and each pair of blocks is a list of its own.
   Two classes of different components that agree on t coordinates meet in
   pass 2, so no link between different texts is lost to the stars.

Large groups of copies never expand into pairs: equal sets are one class, and
near copies cost one star pair per list. The star pairs put documents that are
alike into groups; candidates of both passes travel packed by pairs of groups,
and a set is sent once to each pair of groups, so near misses cost their ids, not
their texts, per pair, and the copies of a set do not grow with the corpus.

Edge cases: null or empty text has no shingles, is its own component and is
kept; rows that share a doc_id are one document of the graph; a row without id
takes its class's component (null, and kept, if no row of the class has one);
an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pipewright.llm.common import cut, mix, partitions, shingles, slices, word_hashes
from pipewright.llm.components import components

COORDS = 32
SIGMAS = 4.5
SPLIT = 200_000
LIST_ROWS = 8192  # rows of a list, or of each of the two blocks of one, that are compared in one go
BLOCK = 512  # documents of a group whose sets are held together
BROADCAST_IDS = 1_000_000  # ids (8 bytes each) that may be broadcast to find the texts of candidates
_A, _B = np.random.default_rng(20240229).integers(0, 2**64 - 1, (2, COORDS), dtype=np.uint64)
_A |= np.uint64(1)
SKETCH = "doc_id long, n_shingles long, s_hi long, s_lo long, sig binary"


def match_threshold(percent: int) -> int:
    j = percent / 100
    return max(1, math.floor(COORDS * j - SIGMAS * math.sqrt(COORDS * j * (1 - j))))


def signature(s: np.ndarray) -> np.ndarray:
    best = np.full(COORDS, 2**32 - 1, np.uint32)
    for i in range(0, len(s), 4096):  # keeps the products of a very long text in cache
        v = (s[i:i + 4096, None] * _A + _B) >> np.uint64(32)
        best = np.minimum(best, v.min(axis=0).astype(np.uint32))
    return best


def _sketch(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words, ends = word_hashes(part.column("text"))
            n, hi, lo, sig = [], [], [], []
            for a, b in zip(ends[:-1], ends[1:]):
                s = shingles(words[a:b], width)
                n.append(len(s))
                d = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                hi.append(int(d[0]))
                lo.append(int(d[1]))
                sig.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()),
                 pa.array(sig, pa.binary())], names=["doc_id", "n_shingles", "s_hi", "s_lo", "sig"])
    return run


def _sigs(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint32).reshape(-1, COORDS)


def _steps(n: np.ndarray, percent: int) -> np.ndarray:
    """Size class: equal or neighbouring for sizes within ``percent`` of each other (the scale is a hair coarser)."""
    return np.floor(np.log(n) / (math.log(100 / percent) * 1.0001)).astype(np.int64) if percent < 100 else n


def _post(prefix: int, percent: int):
    """Rows under (size step, coordinate, value); ``up`` marks the step above the row's own."""
    at = (np.arange(prefix, dtype=np.int64) << 32)[None, :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                keys = _sigs(b.column("sig"))[:, :prefix].astype(np.int64) | at
                keys |= (_steps(b.column("n").to_numpy(), percent) << 38)[:, None]
                keys = np.concatenate([keys, keys + (1 << 38)], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(np.repeat(b.column("rep").to_numpy(), 2 * prefix)),
                     pa.array(np.tile(np.repeat([False, True], prefix), b.num_rows))], names=["key", "rep", "up"])
    return run


def _repost(prefix: int, names: list[str]):
    """Rows of large lists under each coordinate that may be the next common one; ``up2``: the list they come from."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            masks = b.column("mask").to_numpy()
            for mask in np.unique(masks).tolist():
                part = b.filter(pa.array(masks == mask))
                j = np.arange(mask.bit_length(), min(COORDS, prefix + mask.bit_count()))
                if not len(j):
                    continue
                values = _sigs(part.column("sig"))[:, j].astype(np.uint64) | (j.astype(np.uint64) << np.uint64(32))
                up = part.column("key2").to_numpy()
                keys = mix(up.view(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + values).view(np.int64)
                idx = pa.array(np.repeat(np.arange(part.num_rows), len(j)))
                new = {"key2": pa.array(keys.ravel()), "up2": pa.array(np.repeat(up, len(j))),
                       "mask": pa.array(np.tile(mask | (1 << j), part.num_rows))}
                yield pa.RecordBatch.from_arrays([new[c] if c in new else part.column(c).take(idx) for c in names], names=names)
    return run


def _blocks(list_rows: int, names: list[str]):
    """Rows of a list of ``size`` rows under each pair of blocks they belong to; ``side`` 0: one block, 1, 2: first, second."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            many = -(-b.column("size").to_numpy() // list_rows)
            for n in np.unique(many).tolist():
                part = b.filter(pa.array(many == n))
                for at in range(0, part.num_rows, max(1, 20_000 // n)):
                    rows = part.slice(at, max(1, 20_000 // n))
                    x = (mix(rows.column("rep").to_numpy().view(np.uint64)) % np.uint64(n)).astype(np.int64)[:, None]
                    y = np.arange(n)[None, :]
                    pair = (np.minimum(x, y) * n + np.maximum(x, y)).astype(np.uint64)
                    keys = rows.column("key2").to_numpy().view(np.uint64)[:, None]
                    keys = mix(keys + (pair + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) if n > 1 else keys
                    idx = pa.array(np.repeat(np.arange(rows.num_rows), n))
                    new = {"key2": pa.array(keys.view(np.int64).ravel()),
                           "side": pa.array(np.where(x == y, 0, np.where(x < y, 1, 2)).ravel(), pa.int32())}
                    yield pa.RecordBatch.from_arrays([new[c] if c in new else rows.column(c).take(idx) for c in names], names=names)
    return run


def _packed(a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray) -> pa.RecordBatch:
    """Pairs as one row per pair of groups, the ids packed; the smaller id first, the groups in order."""
    ids = np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)
    x, y = np.minimum(ga, gb), np.maximum(ga, gb)
    order = np.lexsort((y, x))
    x, y, ids = x[order], y[order], ids[order]
    cuts = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])][:len(x)])
    return pa.RecordBatch.from_arrays(
        [pa.array(x[cuts]), pa.array(y[cuts]), pa.array([ids[u:v].tobytes() for u, v in zip(cuts, np.r_[cuts[1:], len(x)])], pa.binary())],
        names=["ga", "gb", "pairs"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield _packed(*(b.column(c).to_numpy() for c in ("a", "b", "ga", "gb")))


PAIRS = "ga long, gb long, pairs binary"


def _agree(percent: int, least: int):
    """Of (a, b, sig_a, sig_b, n_a, n_b) the pairs whose signatures and set sizes allow a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            same = (_sigs(b.column("sig_a")) == _sigs(b.column("sig_b"))).sum(axis=1)
            na, nb = b.column("n_a").to_numpy(), b.column("n_b").to_numpy()
            ok = (same >= least) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))
            yield pa.RecordBatch.from_arrays([b.column(c).filter(pa.array(ok)) for c in "ab"], names=["a", "b"])
    return run


def _compare(key: int, mask: int, side: np.ndarray, comp: np.ndarray, rep: np.ndarray, g: np.ndarray, n: np.ndarray, sig: np.ndarray,
             percent: int, least: int) -> list[tuple[np.ndarray, ...]]:
    """Pairs of one list (rows sorted by component) in different components that may be linked, and their groups.

    ``mask``: the coordinates that the list was posted under; ``side``: see ``_blocks``.
    """
    out = []
    before = [c for c in range(mask.bit_length()) if not mask >> c & 1]
    low = _steps(n, percent) < key >> 38  # two rows of the lower step meet in that step's list
    one, two = (np.flatnonzero(side == s) for s in (1, 2)) if side.any() else (np.arange(len(rep)),) * 2
    last = np.searchsorted(comp, comp, side="right")  # inside a block a row meets the rows of later components
    step = max(1, 2_000_000 // (COORDS * max(1, len(two))))
    for a in range(0, len(one), step):
        i = one[a:a + step]
        j = two if one is not two else two[last[i[0]]:]
        if not len(j):
            break
        eq = sig[i][:, None, :] == sig[None, j, :]
        ok = (eq.sum(axis=2) >= least) & (comp[i][:, None] != comp[None, j])
        nn = n[None, j], n[i][:, None]
        ok &= 100 * np.minimum(*nn) >= percent * np.maximum(*nn)
        ok &= ~(low[i][:, None] & low[None, j])
        ok &= ~eq[:, :, before].any(axis=2) if before else True  # else another list has the pair
        x, y = np.nonzero(ok)
        if len(x):
            out.append((rep[i[x]], rep[j[y]], g[i[x]], g[j[y]]))
    return out


def _lists(percent: int, least: int):
    """Streams rows sorted by (key, key2, comp); compares list by list."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def emit(t: pa.Table) -> Iterator[pa.RecordBatch]:
            k1, k2 = t.column("key").to_numpy(), t.column("key2").to_numpy()
            mask, side, comp, rep, g, n = (t.column(c).to_numpy() for c in ("mask", "side", "comp", "rep", "g", "n"))
            sig = _sigs(t.column("sig").combine_chunks())
            cuts = np.flatnonzero(np.r_[True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])
            found = []
            for a, b in zip(cuts, np.r_[cuts[1:], len(k1)]):
                found += _compare(int(k1[a]), int(mask[a]), side[a:b], comp[a:b], rep[a:b], g[a:b], n[a:b], sig[a:b], percent,
                                  least)
            if found:
                yield _packed(*(np.concatenate(v) for v in zip(*found)))

        for batch in batches:
            if not batch.num_rows:
                continue
            k1, k2 = batch.column("key").to_numpy(), batch.column("key2").to_numpy()
            open_at = int(np.flatnonzero((k1 != k1[-1]) | (k2 != k2[-1]))[-1]) + 1 if (
                (k1 != k1[-1]) | (k2 != k2[-1])).any() else 0
            same = held and held[-1].column("key")[-1].as_py() == k1[0] and held[-1].column("key2")[-1].as_py() == k2[0]
            if held and (open_at or not same):
                done = held + ([batch.slice(0, open_at)] if open_at else [])
                yield from emit(pa.Table.from_batches(done))
                held = [batch.slice(open_at)]
            elif held:
                held.append(batch)
            else:
                if open_at:
                    yield from emit(pa.Table.from_batches([batch.slice(0, open_at)]))
                held = [batch.slice(open_at)]
        if held:
            yield from emit(pa.Table.from_batches(held))
    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words, ends = word_hashes(part.column("text"))
            sets = [shingles(words[a:b], width).tobytes() for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sets, pa.binary())], names=["sid", "members"])
    return run


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams packed pairs sorted by (ga, gb): the documents that each pair of groups needs, each once."""
    at, ids = None, np.zeros(0, np.int64)

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), v, np.int64)) for v in at] + [pa.array(ids)],
                                          names=["ga", "gb", "id"])
    for batch in batches:
        for x, y, pairs in zip(*(batch.column(c).to_pylist() for c in ("ga", "gb", "pairs"))):
            if at != (x, y):
                if at is not None:
                    yield rows()
                at, ids = (x, y), np.zeros(0, np.int64)
            ids = np.union1d(ids, np.frombuffer(pairs, np.int64))
    if at is not None:
        yield rows()


def _confirm(percent: int):
    """Streams rows sorted by (ga, gb, kind): the shingle sets of a pair of groups (kind 0), then its pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sets, done = None, {}, set()
        for batch in batches:
            out = []
            for x, y, kind, i, data in zip(*(batch.column(c).to_pylist() for c in ("ga", "gb", "kind", "id", "data"))):
                if (x, y) != at:
                    at, sets, done = (x, y), {}, set()
                if kind == 0:
                    sets.setdefault(i, []).append(np.frombuffer(data, np.uint64))
                    continue
                for a, b in map(tuple, np.frombuffer(data, np.int64).reshape(-1, 2).tolist()):
                    if (a, b) not in done:
                        done.add((a, b))
                        if any(_similar(u, v, percent) for u in sets.get(a, ()) for v in sets.get(b, ())):
                            out.append((a, b))
            if out:
                a, b = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    at = np.searchsorted(x, y)
    both = int((x[np.minimum(at, len(x) - 1)] == y).sum()) if len(x) else 0
    return 100 * both >= percent * (len(x) + len(y) - both)


def _groups(pairs: DataFrame) -> DataFrame:
    """(v, g): the group of every document of the star ``pairs``.

    A document joins the neighbour (or itself) with the most pairs, and goes on
    to the one that this neighbour has joined: documents that are alike share a
    group, so a set goes to few pairs of groups however large the corpus is. A
    group of more than ``BLOCK`` documents is dealt into parts of about that size.
    """
    both = pairs.select(F.col("a").alias("v"), F.col("b").alias("o")).union(pairs.select("b", "a"))
    degree = cut(both.groupBy("v").agg(F.count("*").alias("d")))
    rank = degree.select(F.col("v").alias("__o"), F.struct("d", F.bitwise_not("v").alias("i")).alias("rank"))
    near = both.union(degree.select("v", "v"))
    near = near.join(rank, near["o"] == rank["__o"]).groupBy("v").agg(F.max("rank")["i"].alias("i"))
    first = cut(near.select("v", F.bitwise_not("i").alias("first")))
    then = first.select(F.col("v").alias("__v"), F.col("first").alias("head"))
    heads = cut(first.join(then, first["first"] == then["__v"]).select("v", "head"))
    large = cut(heads.groupBy("head").agg(F.count("*").alias("m")).where(F.col("m") > BLOCK).select(F.col("head").alias("__h"), "m"))
    part = F.pmod(F.xxhash64("v"), F.coalesce(F.ceil(F.col("m") / BLOCK), F.lit(1)))
    return cut(heads.join(large, heads["head"] == large["__h"], "left").select("v", F.xxhash64("head", part).alias("g")))


def _linked(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of the packed ``pairs`` whose full shingle sets reach the threshold.

    A document's set travels once to each pair of groups that needs it, not once per pair.
    """
    pairs = cut(pairs.repartition(partitions(docs.sparkSession), "ga", "gb"))
    need = cut(pairs.sortWithinPartitions("ga", "gb").mapInArrow(_members, "ga long, gb long, id long"))
    ids = cut(need.select(F.col("id").alias("__id")).distinct())
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = slim.join(ids, slim["doc_id"] == ids["__id"], "left_semi").mapInArrow(_sets(width), "sid long, members binary")
    sent = need.join(sets, need["id"] == sets["sid"]).select("ga", "gb", F.lit(0).alias("kind"), "id", F.col("members").alias("data"))
    asked = pairs.select("ga", "gb", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("id"), F.col("pairs").alias("data"))
    meet = sent.unionByName(asked).repartition(partitions(docs.sparkSession), "ga", "gb").sortWithinPartitions("ga", "gb", "kind")
    return cut(meet.mapInArrow(_confirm(percent), "a long, b long"))


def _sized(rows: DataFrame, *keys: str) -> DataFrame:
    """The lists of ``rows`` with pairs of different components: keys, ``size`` (rows), ``cross`` (such pairs)."""
    lists = rows.groupBy(*keys, "comp").agg(F.count("*").alias("m")).groupBy(*keys).agg(
        F.sum("m").alias("size"), ((F.sum("m").cast("double") * F.sum("m") - F.sum(F.col("m").cast("double") * F.col("m"))) / 2).alias("cross"))
    return lists.where("cross > 0")


def _work(level: DataFrame, prefix: int, least: int) -> DataFrame:
    """The rows of the lists to compare: large lists posted under further coordinates, then cut into blocks."""
    kept, out = level.columns, []
    narrow, wide = ("key long, up2 long, key2 long, mask long, comp long",
                    "key long, key2 long, mask long, comp long, rep long, g long, n long, sig binary")
    names = lambda schema: [c.split()[0] for c in schema.split(", ")]
    many = F.bit_count("mask")  # from the second time on only lists too long to be compared in one go
    over = (F.col("cross") > SPLIT) & (many < least) & ((many == 1) | (F.col("size") > LIST_ROWS))
    while not (large := level.where(over)).isEmpty():
        kids = large.select("key", "key2", "mask", "comp", "sig").mapInArrow(_repost(prefix, names(narrow)), narrow)
        kids = cut(_sized(kids, "key", "up2", "key2", "mask"))
        total = kids.groupBy("key", "up2").agg(F.sum("cross").alias("__total")).withColumnsRenamed({"key": "__k", "up2": "__u"})
        level = level.join(total, (level["key"] == total["__k"]) & (level["key2"] == total["__u"]), "left")
        level = cut(level.withColumn("__again", over & (F.coalesce("__total", F.lit(0.0)) < F.col("cross"))))
        out.append(level.where(~F.col("__again")).select(*kept))
        again = level.where("__again").select(*names(wide)).mapInArrow(_repost(prefix, names(wide)), wide)
        kids = kids.select(F.col("key").alias("__k"), F.col("key2").alias("__k2"), "size", "cross")
        level = cut(again.join(kids, (again["key"] == kids["__k"]) & (again["key2"] == kids["__k2"])).select(*kept))
    out.append(level)
    rows = out[0]
    for more in out[1:]:
        rows = rows.unionByName(more)
    cols = "key long, key2 long, mask long, side int, comp long, rep long, g long, n long, sig binary"
    return rows.drop("cross").mapInArrow(_blocks(LIST_ROWS, names(cols)), cols)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, s_hi, s_lo (hash of the shingle set), n_shingles, component_id, kept; one row per row of ``docs``."""
    least = match_threshold(percent)
    prefix = COORDS - least + 1
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch = cut(slim.mapInArrow(_sketch(width), SKETCH))
    classes = sketch.where("n_shingles > 0").groupBy("s_hi", "s_lo").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
    classes = cut(classes)
    reps = classes.where("rep is not null").select("rep", "n", "sig")

    posts = reps.mapInArrow(_post(prefix, percent), "key long, rep long, up boolean")
    lists = posts.groupBy("key").agg(F.count("*").alias("size"), F.min("up").alias("up"))
    lists = lists.where((F.col("size") > 1) & ~F.col("up")).select(F.col("key").alias("__k"), "size")
    shared = cut(posts.join(lists, posts["key"] == lists["__k"]).select("key", "rep", "size"))

    # star pass
    weight = shared.groupBy("rep").agg(F.sum("size").alias("w")).select(F.col("rep").alias("__r"), "w")
    heavy = shared.join(weight, shared["rep"] == weight["__r"]).groupBy("key").agg(
        F.max(F.struct(F.col("w"), (-F.col("rep")).alias("r")))["r"].alias("c")).select(
        F.col("key").alias("__k"), (-F.col("c")).alias("center"))
    stars = shared.join(heavy, shared["key"] == heavy["__k"]).where("rep <> center").groupBy(
        F.least("center", "rep").alias("a"), F.greatest("center", "rep").alias("b")).agg(F.count("*").alias("collisions"))
    one, two = (reps.select(F.col("rep").alias(f"r_{c}"), F.col("n").alias(f"n_{c}"), F.col("sig").alias(f"sig_{c}")) for c in "ab")
    full = stars.join(one, stars["a"] == one["r_a"]).join(two, stars["b"] == two["r_b"])
    close = full.select("a", "b", "n_a", "n_b", "sig_a", "sig_b").mapInArrow(_agree(percent, least), "a long, b long")
    close = cut(close)
    groups = _groups(close)
    one, two = (groups.select(F.col("v").alias(f"v_{c}"), F.col("g").alias(f"g{c}")) for c in "ab")
    close = close.join(one, close["a"] == one["v_a"]).join(two, close["b"] == two["v_b"])
    close = close.repartition(partitions(docs.sparkSession), "ga", "gb").mapInArrow(_pack, PAIRS)
    links = _linked(close, docs, width, percent)
    comp = components(links)

    # skip pass
    lab = comp.select(F.col("node").alias("__n"), F.col("comp").alias("__c"))
    marked = shared.join(lab, shared["rep"] == lab["__n"], "left").select("key", "rep", F.coalesce("__c", "rep").alias("comp"))
    mixed = _sized(marked.withColumn("key2", F.lit(0).cast("long")), "key", "key2")
    mixed = mixed.select(F.col("key").alias("__k"), "size", "cross")
    rest = marked.join(mixed, marked["key"] == mixed["__k"]).drop("__k")
    rest = rest.join(reps.select(F.col("rep").alias("__r"), "n", "sig"), F.col("rep") == F.col("__r"))
    known = groups.select(F.col("v").alias("__v"), "g")
    rest = rest.join(known, rest["rep"] == known["__v"], "left").withColumn("g", F.coalesce("g", F.xxhash64("rep")))
    own = F.expr("shiftleft(cast(1 as bigint), cast(shiftright(key, 32) & 63 as int))").alias("mask")
    rest = cut(rest.select("key", F.lit(0).cast("long").alias("key2"), own, "comp", "rep", "g", "n", "sig", "size", "cross"))
    work = _work(rest, prefix, least)
    work = work.repartition(partitions(docs.sparkSession), "key", "key2").sortWithinPartitions("key", "key2", "comp")
    more = work.mapInArrow(_lists(percent, least), PAIRS)
    comp = components(links.union(_linked(more, docs, width, percent)))

    lab = comp.select(F.col("node").alias("__n"), F.col("comp").alias("__c"))
    known = classes.select(F.col("s_hi").alias("__hi"), F.col("s_lo").alias("__lo"), "rep")
    known = known.join(lab, known["rep"] == lab["__n"], "left").select("__hi", "__lo", F.coalesce("__c", "rep").alias("__c"))
    out = sketch.join(known, (sketch["s_hi"] == known["__hi"]) & (sketch["s_lo"] == known["__lo"])
                      & (sketch["n_shingles"] > 0), "left")
    c = F.when(F.col("n_shingles") > 0, F.col("__c")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "s_hi", "s_lo", "n_shingles", c.alias("component_id"),
                      F.col("doc_id").eqNullSafe(c).alias("kept"))


def apply_near_dedup(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, columns unchanged, of one document (the smallest doc_id) of each group."""
    gone = near_duplicates(docs, width, percent).where(~F.col("kept")).select(F.col("doc_id").alias("__id"), F.lit(1).alias("__g"))
    gone = gone.where("__id is not null").distinct()
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    return row.join(gone, F.col("__row")["doc_id"] == F.col("__id"), "left_anti").select("__row.*")
