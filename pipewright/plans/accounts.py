"""Audited keyed merge of the account table (test-data change set)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pipewright.functions.periods import ReportParams
from pipewright.operators import merge
from pipewright.session import store
from pipewright.sources.tables import read

NEW_KEY_OFFSET = 1_000_000_000


def account_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer, two equal ones for k % 101 = 0 (an ambiguous key)."""
    c = read(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"])
    c = c.withColumn("twice", F.explode(F.when(F.col("c_custkey") % 101 == 0, F.array(F.lit(1), F.lit(2)))
                                         .otherwise(F.array(F.lit(1)))))
    return c.select(F.col("c_custkey").alias("Id"), F.col("c_name").alias("Name"),
                    F.col("c_mktsegment").alias("Segment"), F.col("c_acctbal").alias("Balance"))


def account_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change set derived from the customers (k = customer key):

    k % 7 = 0: balance + 100 (seq 1); k % 49 = 0 also a second row, balance + 200 (seq 2)
    k % 7 = 1: the same values (no actual change)
    k % 11 = 0: a key not in the table (k + 1e9), name prefixed 'New '
    k % 13 = 0: balance + 300 and balance + 400, both seq 3 (a tie: the larger row wins)
    k % 17 = 0: balance + 500 twice, seq 4 (identical rows)
    k % 101 = 0: balance + 600, seq 5 (two target rows); k % 97 = 0: a row without a key
    """
    c = read(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"])
    k = F.col("c_custkey")
    upd = F.struct(k.alias("Id"), F.col("c_name").alias("Name"), F.col("c_mktsegment").alias("Segment"),
                   (F.col("c_acctbal") + F.lit(100.0)).alias("Balance"), F.lit(1).alias("seq"))
    upd2 = F.struct(k.alias("Id"), F.col("c_name").alias("Name"), F.col("c_mktsegment").alias("Segment"),
                    (F.col("c_acctbal") + F.lit(200.0)).alias("Balance"), F.lit(2).alias("seq"))
    same = F.struct(k.alias("Id"), F.col("c_name").alias("Name"), F.col("c_mktsegment").alias("Segment"),
                    F.col("c_acctbal").alias("Balance"), F.lit(1).alias("seq"))
    new = F.struct((k + F.lit(NEW_KEY_OFFSET)).alias("Id"), F.concat(F.lit("New "), F.col("c_name")).alias("Name"),
                   F.col("c_mktsegment").alias("Segment"), F.col("c_acctbal").alias("Balance"), F.lit(1).alias("seq"))

    def plus(amount: float, seq: int, key=k):
        return F.struct(key.alias("Id"), F.col("c_name").alias("Name"), F.col("c_mktsegment").alias("Segment"),
                        (F.col("c_acctbal") + F.lit(amount)).alias("Balance"), F.lit(seq).alias("seq"))
    rows = F.array(F.when(k % 7 == 0, upd), F.when(k % 49 == 0, upd2), F.when(k % 7 == 1, same),
                   F.when(k % 11 == 0, new), F.when(k % 13 == 0, plus(300.0, 3)), F.when(k % 13 == 0, plus(400.0, 3)),
                   F.when(k % 17 == 0, plus(500.0, 4)), F.when(k % 17 == 0, plus(500.0, 4)),
                   F.when(k % 101 == 0, plus(600.0, 5)),
                   F.when(k % 97 == 0, plus(700.0, 6, F.lit(None).cast("long"))))
    return (c.select(F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("r"))
             .select("r.Id", "r.Name", "r.Segment", "r.Balance", "r.seq"))


def audited_merge(spark: SparkSession, sf_dir: str, p: ReportParams | None = None, mode: str = "upsert") -> DataFrame:
    """Outcome of every change row."""
    return merge.merge_outcomes(account_table(spark, sf_dir), account_changes(spark, sf_dir), "Id", "seq", mode)


def merged_accounts(spark: SparkSession, sf_dir: str, p: ReportParams | None = None, mode: str = "upsert") -> DataFrame:
    return merge.merged_table(account_table(spark, sf_dir), account_changes(spark, sf_dir), "Id", "seq", mode)


def accounts_before_image(spark: SparkSession, sf_dir: str, p: ReportParams | None = None) -> DataFrame:
    return merge.before_image(account_table(spark, sf_dir), account_changes(spark, sf_dir), "Id")


def _revert_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(merged table, before image, change set) of an upsert; the first two are written first, as the published
    merge's are, so that no task of the revert holds the merge's sort buffers beside its own."""
    target, changes = account_table(spark, sf_dir), account_changes(spark, sf_dir)
    return store(merge.merged_table(target, changes, "Id", "seq")), store(merge.before_image(target, changes, "Id")), changes


def reverted_accounts(spark: SparkSession, sf_dir: str, p: ReportParams | None = None) -> DataFrame:
    """Merge and revert: the table before the merge, ambiguous and missing keys included."""
    return merge.revert_table(*_revert_inputs(spark, sf_dir), "Id", "seq")


def _edited_since(merged: DataFrame) -> DataFrame:
    """The merged table after other edits: k % 21 = 0 another balance, k % 22 = 0 gone, k % 26 = 0 doubled (k: the key)."""
    k = F.col("Id")
    copies = F.when(k % 26 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (merged.where(k % 22 != 0).withColumn("Balance", F.when(k % 21 == 0, F.col("Balance") + F.lit(1.0)).otherwise(F.col("Balance")))
                  .withColumn("copy", F.explode(copies)).drop("copy"))


def revert_outcomes(spark: SparkSession, sf_dir: str, p: ReportParams | None = None) -> DataFrame:
    """Outcome per key of reverting a merge in a table that was edited since."""
    merged, before, changes = _revert_inputs(spark, sf_dir)
    return merge.revert_outcomes(_edited_since(merged), before, changes, "Id", "seq")


def reverted_after_edits(spark: SparkSession, sf_dir: str, p: ReportParams | None = None) -> DataFrame:
    """The edited table with the merge undone where it is as the merge left it."""
    merged, before, changes = _revert_inputs(spark, sf_dir)
    return merge.revert_table(_edited_since(merged), before, changes, "Id", "seq")
