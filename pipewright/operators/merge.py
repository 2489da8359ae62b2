"""Keyed update / upsert of a table with an audit trail.

Given a target table and a change set (rows with a key and a sequence
number), produce:

* the merged table (update: changed rows replaced; upsert: plus new keys),
* the before image (target rows whose key the change set touches),
* one outcome per change row:
  'no key'         the row has no key; it changes nothing
  'ambiguous key'  several target rows have the key; none of them is changed
  'superseded'     another row of the key wins
  'updated', 'unchanged', 'inserted', 'missing key' (update mode, key not in the
  target): the one row of the key that wins.

The winner of a key is the row with the largest (sequence, values), so equal
sequence numbers leave nothing to chance; of identical rows one wins. A column
of the change set that the target lacks is an error.

Change rows are counted per distinct row first and reduced to one winner per
key, both combined map-side. A distinct row is cut into chunks of ``CHUNK``
copies, and each chunk meets its key's winner in a join salted ``SALTS`` ways
(the one-row-per-key side is repeated), so neither a key nor a row that makes
up a large part of the change set stays in one task, and no value grows with
the number of copies.

A merge can be undone from its before image and its change set
(``revert_table``): updated rows get their old values back, inserted rows go.
A row that is not as the merge left it (changed, gone or doubled since) is
left alone and reported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pipewright.functions.dims import NOTES_LIMIT
from pipewright.functions.text import truncate_notes

SALTS = 16
CHUNK = 100_000


def _value_cols(target: DataFrame, changes: DataFrame, key: str, seq: str) -> list[str]:
    cols = [c for c in changes.columns if c not in (key, seq)]
    unknown = [c for c in [key, *cols] if c not in target.columns]
    if unknown:
        raise ValueError(f"the target has no column {', '.join(unknown)}")
    return cols


def _winners(target: DataFrame, changes: DataFrame, key: str, seq: str) -> DataFrame:
    """One row per key of the change set: __k, __win (sequence and values), __rows in the target, __was (their values)."""
    cols = _value_cols(target, changes, key, seq)
    win = changes.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__k")).agg(
        F.max(F.struct(seq, *cols)).alias("__win"))
    was = target.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__t")).agg(
        F.count(F.lit(1)).alias("__rows"), F.first(F.struct(F.lit(True).alias("__there"), *cols)).alias("__was"))
    return win.join(was, F.col("__k") == F.col("__t"), "left").drop("__t")


def merge_outcomes(target: DataFrame, changes: DataFrame, key: str, seq: str, mode: str = "upsert") -> DataFrame:
    """Per change row: key, seq, outcome."""
    cols = _value_cols(target, changes, key, seq)
    distinct = changes.groupBy(key, seq, *cols).agg(F.count(F.lit(1)).alias("__copies"))
    distinct = distinct.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(__copies - 1) div {CHUNK}"))))
    distinct = distinct.withColumn("__n", F.least(F.lit(CHUNK), F.col("__copies") - F.col("__chunk") * CHUNK).cast("int"))
    distinct = distinct.withColumn("__salt", F.pmod(F.xxhash64(seq, *cols, "__chunk"), F.lit(SALTS)))
    win = _winners(target, changes, key, seq).withColumn(
        "__s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    df = distinct.join(win, (distinct[key] == win["__k"]) & (distinct["__salt"] == win["__s"]), "left")
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"__win.{c}").eqNullSafe(F.col(f"__was.{c}"))
    won = (F.when(F.col("__rows").isNull(), F.lit("inserted" if mode == "upsert" else "missing key"))
            .when(same, F.lit("unchanged")).otherwise(F.lit("updated")))
    first = F.struct(seq, *cols).eqNullSafe(F.col("__win")) & (F.col("__chunk") == 0)
    rest = F.array_repeat(F.lit("superseded"), F.col("__n") - F.when(first, 1).otherwise(0))
    every = (F.when(F.col(key).isNull(), F.array_repeat(F.lit("no key"), F.col("__n")))
              .when(F.col("__rows") > 1, F.array_repeat(F.lit("ambiguous key"), F.col("__n")))
              .when(first, F.concat(F.array(won), rest)).otherwise(rest))
    return df.select(key, seq, F.explode(every).alias("outcome"))


def merged_table(target: DataFrame, changes: DataFrame, key: str, seq: str, mode: str = "upsert") -> DataFrame:
    """The target after applying the winning change of each key."""
    cols = _value_cols(target, changes, key, seq)
    win = _winners(target, changes, key, seq)
    use = win.where(F.col("__rows") == 1).select("__k", "__win")
    df = target.join(use, target[key] == use["__k"], "left")
    there = F.col("__k").isNotNull()
    out = df.select(*[F.when(there, F.col(f"__win.{c}")).otherwise(target[c]).alias(c) if c in cols else target[c]
                      for c in target.columns])
    if mode != "upsert":
        return out
    new = win.where(F.col("__rows").isNull())
    types = dict(target.dtypes)
    return out.unionByName(new.select(
        F.col("__k").cast(types[key]).alias(key),
        *[(F.col(f"__win.{c}") if c in cols else F.lit(None)).cast(types[c]).alias(c) for c in target.columns if c != key]))


def before_image(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Target rows a change set touches (to revert from); the change keys are
    made distinct first (combined map-side), so a repeated key is one row."""
    ks = changes.select(F.col(key).alias("__k")).distinct()
    return target.join(ks, target[key] == ks["__k"], "left_semi")


def inverse_changes(before: DataFrame, changes: DataFrame, key: str, seq: str, mode: str = "upsert") -> DataFrame:
    """What undoes a merge, one row per key: ``__k``, ``undo`` ('restore' or 'delete'), ``__was`` (the values
    before) and ``__left`` (the values that the merge left). Keys that the merge did not change have none."""
    cols = _value_cols(before, changes, key, seq)
    win = _winners(before, changes, key, seq)
    left = F.struct(*[F.col(f"__win.{c}").alias(c) for c in cols])
    was = F.struct(*[F.col(f"__was.{c}").alias(c) for c in cols])
    undo = F.when((F.col("__rows") == 1) & ~left.eqNullSafe(was), F.lit("restore"))
    if mode == "upsert":
        undo = undo.when(F.col("__rows").isNull(), F.lit("delete"))
    out = win.select("__k", undo.alias("undo"), was.alias("__was"), left.alias("__left"))
    return out.where(F.col("undo").isNotNull())


def _undoing(now: DataFrame, before: DataFrame, changes: DataFrame, key: str, seq: str, mode: str) -> DataFrame:
    """Inverse changes with ``outcome``: 'restored', 'deleted', 'changed since' or 'gone'."""
    cols = _value_cols(before, changes, key, seq)
    inverse = inverse_changes(before, changes, key, seq, mode)
    held = now.groupBy(F.col(key).alias("__now")).agg(F.count(F.lit(1)).alias("__rows"), F.max(F.struct(*cols)).alias("__is"))
    same = (F.col("__rows") == 1) & F.col("__is").eqNullSafe(F.col("__left"))
    done = F.when(F.col("undo") == "restore", F.lit("restored")).otherwise(F.lit("deleted"))
    return inverse.join(held, F.col("__k") == F.col("__now"), "left").withColumn(
        "outcome", F.when(F.col("__rows").isNull(), F.lit("gone")).when(same, done).otherwise(F.lit("changed since")))


def revert_outcomes(now: DataFrame, before: DataFrame, changes: DataFrame, key: str, seq: str, mode: str = "upsert") -> DataFrame:
    """Per key that the merge changed: key, what became of undoing it in ``now``."""
    return _undoing(now, before, changes, key, seq, mode).select(F.col("__k").alias(key), "outcome")


def revert_table(now: DataFrame, before: DataFrame, changes: DataFrame, key: str, seq: str, mode: str = "upsert") -> DataFrame:
    """``now`` with the merge undone wherever it is as the merge left it."""
    cols = _value_cols(before, changes, key, seq)
    undo = _undoing(now, before, changes, key, seq, mode).where(F.col("outcome").isin("restored", "deleted"))
    df = now.join(undo.select("__k", "outcome", "__was"), now[key] == F.col("__k"), "left")
    df = df.where(F.coalesce(F.col("outcome") != "deleted", F.lit(True)))
    return df.select(*[F.when(F.col("outcome").isNotNull(), F.col(f"__was.{c}")).otherwise(now[c]).alias(c) if c in cols else now[c]
                       for c in now.columns])


def notes_table(spark, notes: str | None, limit: int = NOTES_LIMIT) -> DataFrame | None:
    """One-row table holding the run's notes, cut below the cell limit."""
    text = truncate_notes(notes, limit)
    return None if text is None else spark.createDataFrame([(text,)], "notes string")


def run_audited_merge(spark, target: DataFrame, changes: DataFrame, key: str, seq: str, out_dir: str,
                      mode: str = "upsert", notes: str | None = None, fmt: str = "parquet") -> dict[str, int]:
    """Job: publish the change set, the before image, the per-row outcome, the
    merged table, the mode and the notes as one run of ``out_dir``; rows per table.

    The change set is written to the shared folder first and every output is
    computed from the written rows, so they cannot disagree; the merged table
    goes to its own folder, so the target is never read and overwritten by the
    same job.
    """
    from pipewright.session import store
    from pipewright.sources.publish import publish
    changes = store(changes)
    tables = {"upload_file": changes, "before_upload": before_image(target, changes, key),
              "upload_results": merge_outcomes(target, changes, key, seq, mode),
              "merged": merged_table(target, changes, key, seq, mode),
              "run": spark.createDataFrame([(mode, key, seq)], "mode string, key string, seq string")}
    if (table := notes_table(spark, notes)) is not None:
        tables["notes"] = table
    return publish(spark, out_dir, tables, fmt)


def run_revert(spark, now: DataFrame, merge_dir: str, key: str, seq: str, out_dir: str, fmt: str = "parquet") -> dict[str, int]:
    """Job: undo the merge published (as parquet) in ``merge_dir`` in the table as it is ``now``; publish the
    reverted table and the outcome per key."""
    from pipewright.sources.publish import publish, read_published
    run = read_published(spark, merge_dir, "run").first()
    if (run.key, run.seq) != (key, seq):
        raise ValueError(f"the merge was keyed by {run.key}, ordered by {run.seq}")
    before, changes = read_published(spark, merge_dir, "before_upload"), read_published(spark, merge_dir, "upload_file")
    return publish(spark, out_dir, {"reverted": revert_table(now, before, changes, key, seq, run.mode),
                                    "revert_results": revert_outcomes(now, before, changes, key, seq, run.mode)}, fmt)
