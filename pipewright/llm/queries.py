"""Registered queries of the numbered operators over the whole ``documents`` table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pipewright.llm import oracle
from pipewright.llm.common import documents, fold  # noqa: F401


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pipewright.llm.substring_dedup import substring_dedup
    d = substring_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return d.select(F.col("row.doc_id").alias("doc_id"), "n_sentences", "n_removed", "text")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pipewright.llm.toxicity import FOLDS, score, train
    docs = documents(spark, sf_dir)
    s = score(docs, train(docs, _read(spark, sf_dir, "labels")))
    return s.select("*", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), (F.col("p_toxic") >= 0.5).alias("toxic"))


def op3_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pipewright.llm.quality_cnn import FOLDS, score, train
    docs = documents(spark, sf_dir)
    net = train(docs, _read(spark, sf_dir, "labels"))
    return score(docs, net).select("doc_id", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score",
                                   (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pipewright.llm.line_dedup import line_dedup
    d = line_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return d.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped",
                    F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pipewright.llm.lm_trie import lm_scores
    return lm_scores(documents(spark, sf_dir))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pipewright.llm.quality_rules import rules
    r = rules(documents(spark, sf_dir), _read(spark, sf_dir, "labels"))
    return r.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pipewright.llm.decontaminate import contamination
    c = contamination(documents(spark, sf_dir).select("doc_id", "text"), _read(spark, sf_dir, "benchmark"))
    ids = F.concat_ws(",", F.sort_array("items"))
    return c.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(ids.cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pipewright.llm.language_id import FOLDS, HELD, predict, train
    docs = documents(spark, sf_dir)
    return predict(docs, train(docs)).select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD).alias("held_out"),
                                             "lang_pred", "score")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pipewright.llm.packing import pack
    return pack(documents(spark, sf_dir))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pipewright.llm.minhash_join import near_duplicates
    d = near_duplicates(documents(spark, sf_dir), width=3, percent=85)
    return d.select("doc_id", "n_shingles", "component_id", "kept")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pipewright.llm.conversation_repair import damaged, repair
    return repair(damaged(_read(spark, sf_dir, "conversations")), _read(spark, sf_dir, "conversations").select("conv_id"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pipewright.llm.spelling_variants import misspelt_words, variants
    return variants(misspelt_words(documents(spark, sf_dir)))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pipewright.llm.suffix_dedup import suffix_dedup
    d = suffix_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return d.select(F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_quality_cnn": op3_quality_cnn,
    "op4_line_dedup": op4_line_dedup,
    "op5_lm_scores": op5_lm_scores,
    "op6_quality_rules": op6_quality_rules,
    "op7_decontamination": op7_decontamination,
    "op8_language_id": op8_language_id,
    "op9_packing": op9_packing,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_suffix_dedup": op13_suffix_dedup,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in oracle.SQL.items() if k in QUERIES}
