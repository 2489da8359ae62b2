"""Conflict-constrained best-fit packing of documents into bins of a fixed token capacity.

A document takes its words plus one end marker. Its full-capacity parts take a
bin each; the rest is packed best-fit in order of decreasing length: bins are
kept by residual capacity, and a successor search (a bitmap of the residuals in
use) goes from the tightest residual that fits to larger ones until a bin
without conflict is found. A bin carries two bitmaps: ``per_source`` bits for
each source, all set when the source may not enter again, and one bit for each
duplicate cluster in it; no bin holds two documents of one cluster.

Documents are dealt by hash to shards of about ``SHARD_DOCS`` documents, each
packed in one task; only ids, lengths, sources and clusters travel, never
texts. Bins are not shared between shards.

Edge cases: null or empty text takes one token and belongs to no cluster; a
null source is a source of its own; repeated rows are placed each; ties are
broken by cluster, source and doc_id (null ids first); an empty table gives an
empty result; extra columns are ignored whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pipewright.llm.common import WORD, WS

CAPACITY = 4096
PER_SOURCE = 8
SHARD_DOCS = 8192
PLACED = "doc_id long, part long, start long, n_tokens long, bin_id long, bin_start long"


def best_fit(items: list[tuple[int, int, int]], capacity: int, per_source: int) -> list[tuple[int, int]]:
    """(bin, start in bin) of each (length, source index, cluster index or -1), in the given order."""
    at: dict[int, list[int]] = {}  # residual -> bins
    used = 0                       # bit r: some bin has residual r
    sources: list[int] = []
    clusters: list[int] = []
    room = (1 << per_source) - 1
    out = []
    for n, source, cluster in items:
        full = room << (source * per_source)
        mark = 1 << cluster if cluster >= 0 else 0
        left, bin_, r = used >> n, -1, n
        while left:
            skip = (left & -left).bit_length() - 1
            r += skip
            for i, b in enumerate(at[r]):
                if not clusters[b] & mark and sources[b] & full != full:
                    bin_ = b
                    at[r][i] = at[r][-1]
                    at[r].pop()
                    break
            if bin_ >= 0:
                break
            left >>= skip + 1
            r += 1
        if bin_ < 0:
            bin_, r = len(sources), capacity
            sources.append(0)
            clusters.append(0)
        elif not at[r]:
            used &= ~(1 << r)
        taken = (sources[bin_] & full) >> (source * per_source)
        sources[bin_] |= (taken + 1 & ~taken) << (source * per_source)
        clusters[bin_] |= mark
        out.append((bin_, capacity - r))
        at.setdefault(r - n, []).append(bin_)
        used |= 1 << r - n
    return out


def _pack(capacity: int, per_source: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["cluster", "source", "doc_id"], na_position="first", kind="stable")
        ids = pdf["doc_id"].astype("Int64").tolist()
        lengths = pdf["n_tokens"].tolist()
        names = {s: i for i, s in enumerate(dict.fromkeys(pdf["source"].tolist()))}
        source = [names[s] for s in pdf["source"].tolist()]
        groups = [None if pd.isna(c) else int(c) for c in pdf["cluster"].astype("Int64").tolist()]
        size = Counter(groups)
        bits = {c: i for i, c in enumerate(c for c in size if c is not None and size[c] > 1)}  # others never conflict
        tails = [(n % capacity, s, bits.get(g, -1), i) for i, (n, s, g) in enumerate(zip(lengths, source, groups))]
        tails = sorted((t for t in tails if t[0]), key=lambda t: -t[0])
        placed = best_fit([t[:3] for t in tails], capacity, per_source)
        rows = [(ids[t[3]], lengths[t[3]] // capacity, lengths[t[3]] - t[0], t[0], b, s) for t, (b, s) in zip(tails, placed)]
        n_bins = max((b for b, _ in placed), default=-1) + 1
        for d, n in zip(ids, lengths):
            for part in range(n // capacity):
                rows.append((d, part, part * capacity, capacity, n_bins, 0))
                n_bins += 1
        out = pd.DataFrame(rows, columns=["doc_id", "part", "start", "n_tokens", "bin_id", "bin_start"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        out["bin_id"] += int(key[0]) << 32
        return out
    return run


def text_cluster(text: Column) -> Column:
    """Cluster of exact copies: hash of the text with A-Z lowered and whitespace runs as one blank; null without a word."""
    flat = F.trim(F.regexp_replace(F.lower(text), WS + "+", " "))
    return F.when(flat != "", F.xxhash64(flat))


def pack(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, cluster: Column | None = None) -> DataFrame:
    """One row per placed part: doc_id, part, start (token in the document), n_tokens, bin_id, bin_start.

    ``cluster``: a long column that groups duplicates (null: in no cluster);
    by default exact copies of the normalised text.
    """
    cluster = text_cluster(F.col("text")) if cluster is None else cluster
    tokens = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD + "+")) + 1
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                    tokens.cast("long").alias("n_tokens"), cluster.cast("long").alias("cluster"))
    shards = max(1, math.ceil(docs.count() / SHARD_DOCS))
    d = d.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster"), F.lit(shards)))
    return d.groupBy("shard").applyInPandas(_pack(capacity, per_source), PLACED)
