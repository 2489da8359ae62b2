"""Quality rules with risk-controlled cutoffs (DataFrame and SQL functions only).

Every document gets integer counts; ``base_failed`` is a fixed rule on them. A
further rule compares 100 * numerator with cutoff * denominator. Its cutoff is
chosen per stratum (language) from labelled documents that pass the base rule:

* for every (stratum, rule, cutoff) the labelled good documents it would reject
  are counted, k of n;
* the cutoff is certified if the exact binomial probability of seeing k or
  fewer at a true false-rejection rate of ``alpha`` is at most delta / tests,
  where tests = strata x rules x cutoffs (Bonferroni), so with probability
  1 - delta no certified cutoff of any stratum rejects more than ``alpha`` of
  its good documents;
* of the certified cutoffs that reject any labelled bad document, the one
  rejecting most is used, the loosest on ties; a stratum with too few labels
  to certify anything has no further rule.

Edge cases: null or empty text has no words and fails the base rule; null
``lang`` is the stratum 'und'; a document without label takes part in no
bound; repeated rows each get their own result; a doc_id labelled more than once
or held by several rows counts once per matching pair; empty tables give empty results;
other columns, whatever their names, are ignored (``rules``) or kept as they
are (``apply_rules``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pipewright.llm.common import WORD, WS, cut, store

ALPHA = 0.01   # false-rejection rate allowed to each rule in each stratum
DELTA = 0.05   # probability that any bound of the table is wrong
# rule -> (numerator, denominator, cutoffs in per cent); rejected if 100 * numerator > cutoff * denominator
RULES = {
    "symbols": ("n_symbols", "n_words", (5, 10, 20, 30, 40, 50, 75, 100)),
    "dup_lines": ("n_dup_lines", "n_lines", (10, 20, 30, 40, 50, 60, 75, 90)),
    "repeats": ("n_repeat_words", "n_words", (10, 15, 20, 25, 30, 35, 40, 45)),
    "upper": ("n_upper", "word_chars", (20, 30, 40, 50, 60, 70, 80, 90)),
    "word_length": ("word_chars", "n_words", (800, 1000, 1200, 1500, 2000, 3000, 5000, 10000)),
}
BROADCAST_ROWS = 100_000  # strata of the cutoff table that may be broadcast (a few dozen bytes each)


def _counts(text: Column) -> list[Column]:
    text = F.coalesce(text, F.lit(""))
    return [
        F.filter(F.split(text, WS + "+"), lambda w: w != F.lit("")).alias("__w"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)).alias("__lines"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
    ]


def _windows(w: Column, n: Column) -> Column:
    """(hash, position) of every 3-word window, sorted by hash."""
    idx = F.sequence(F.lit(0), n - 3)
    return F.sort_array(F.transform(idx, lambda i: F.struct(
        F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p"))))


def counts(docs: DataFrame, *carried: str) -> DataFrame:
    """doc_id, stratum, hash of text and language, the integer counts of every row and the columns ``carried``
    along; no shuffle, one pass."""
    d = docs.select(*carried, "doc_id", F.coalesce(F.col("lang"), F.lit("und")).alias("stratum"),
                    F.xxhash64("text", "lang").alias("text_hash"), *_counts(F.col("text")))
    d = d.select(*carried, "doc_id", "stratum", "text_hash", "n_symbols", "n_upper", "__w", F.size("__w").alias("__n"),
                 F.size("__lines").cast("long").alias("n_lines"),
                 (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"))
    d = d.withColumn("word_chars", F.length(F.array_join("__w", "")).cast("long"))
    d = d.withColumn("__s", F.when(F.col("__n") > 3, _windows(F.col("__w"), F.col("__n")))).drop("__w")
    s = F.col("__s")
    twice = F.filter(s, lambda x, j: x["h"].eqNullSafe(F.get(s, j + 1)["h"]) | x["h"].eqNullSafe(F.get(s, j - 1)["h"]))
    d = d.withColumn("__p", F.sort_array(F.transform(twice, lambda x: x["p"]))).drop("__s")
    p = F.col("__p")
    spread = F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3))))
    d = d.withColumn("n_repeat_words",
                     F.coalesce(F.aggregate(spread, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long"))
    d = d.withColumn("n_words", F.col("__n").cast("long"))
    bad = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return d.select("doc_id", "stratum", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "n_lines", "n_upper", bad.alias("base_failed"), *carried)


def _ln_factorial(x: Column) -> Column:
    """ln x! : exact below 20, the Stirling series above (relative error under 1e-13)."""
    small = F.array(*[F.lit(math.lgamma(i + 1)) for i in range(20)])
    d = x.cast("double")
    big = (d + 0.5) * F.log(d) - d + 0.5 * math.log(2 * math.pi) + 1 / (12 * d) - 1 / (360 * d * d * d)
    big = big + 1 / (1260 * F.pow(d, F.lit(5)))
    return F.when(x < 20, F.get(small, x.cast("int"))).otherwise(big)


def binomial_tail(k: Column, n: Column, alpha: float) -> Column:
    """P(Bin(n, alpha) <= k), 1 where k > n * alpha (never certified).

    Terms further than 60 standard deviations below k are under 1e-300 of the
    sum, so the summed range is bounded by the square root of n.
    """
    span = F.ceil(60 * F.sqrt(n * F.lit(alpha)) + 60)
    terms = F.sequence(F.greatest(F.lit(0).cast("long"), k - span.cast("long")), k)
    la, lb = math.log(alpha), math.log1p(-alpha)
    total = F.aggregate(terms, F.lit(0.0), lambda a, i: a + F.exp(
        _ln_factorial(n) - _ln_factorial(i) - _ln_factorial(n - i) + i * F.lit(la) + (n - i) * F.lit(lb)))
    return F.when(k > n * F.lit(alpha), F.lit(1.0)).otherwise(total)


def cutoffs(counted: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per stratum that has a certified rule: stratum and a cutoff column per rule (null: not used)."""
    lab = labels.where("doc_id is not null and quality in (0, 1)").select("doc_id", "quality")
    held = counted.where(~F.col("base_failed")).join(lab, "doc_id")
    tests = [F.struct(F.lit(r).alias("rule"), F.lit(c).alias("cutoff"),
                      (100 * F.col(num) > F.lit(c) * F.col(den)).alias("hit"))
             for r, (num, den, cuts) in RULES.items() for c in cuts]
    t = held.select("stratum", "quality", F.explode(F.array(*tests)).alias("t"))
    good, hit = F.col("quality") == 1, F.col("t.hit")
    g = t.groupBy("stratum", F.col("t.rule").alias("rule"), F.col("t.cutoff").alias("cutoff")).agg(
        F.count(F.when(good, 1)).alias("n"), F.count(F.when(good & hit, 1)).alias("k"),
        F.count(F.when(~good & hit, 1)).alias("caught"))
    g = cut(g)
    n_tests = max(1, g.count())
    sure = g.where(binomial_tail(F.col("k"), F.col("n"), alpha) <= F.lit(delta / n_tests)).where("caught > 0 and n > 0")
    best = sure.groupBy("stratum", "rule").agg(F.max(F.struct("caught", "cutoff"))["cutoff"].alias("cutoff"))
    return best.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}")
                                         for r in RULES])


def _judged(counted: DataFrame, labels: DataFrame, alpha: float, delta: float) -> DataFrame:
    """``counted`` with ``rejected_by`` (names of rules) and ``kept``; the rows stay where they are unless there are
    more than ``BROADCAST_ROWS`` strata with a cutoff."""
    cuts = cut(cutoffs(counted, labels, alpha, delta))
    if cuts.count() <= BROADCAST_ROWS:
        cuts = F.broadcast(cuts)
    j = counted.join(cuts, "stratum", "left")
    fails = F.array_compact(F.array(*[
        F.when(100 * F.col(num) > F.col(f"cut_{r}") * F.col(den), F.lit(r)) for r, (num, den, _) in RULES.items()]))
    j = j.withColumn("rejected_by", F.when(F.col("base_failed"), F.array(F.lit("base"))).otherwise(fails))
    return j.select(*counted.columns, "rejected_by", (F.size("rejected_by") == 0).alias("kept"))


def rules(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """doc_id, the counts, ``base_failed``, the names of the rules that rejected it and ``kept``; one row per row."""
    return _judged(cut(counts(docs)), labels, alpha, delta)


def apply_rules(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns unchanged.

    The pass that counts writes each row beside its counts; the cutoffs read the
    counts alone and are broadcast to the rows, so no text is ever shuffled.
    """
    void = [f.name for f in docs.schema if f.dataType.typeName() == "void"]  # Parquet has no such type; all its values are null
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in void]).alias("__row")
    counted = store(counts(docs.select(row, "doc_id", "text", "lang"), "__row"))
    kept = _judged(counted, labels, alpha, delta).where("kept")
    return kept.select(*[F.lit(None).alias(c) if c in void else F.col("__row")[c].alias(c) for c in docs.columns])
