"""Every operator and stage on odd rows and on empty tables: no crash, one result per row, defined values."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pipewright.llm import byte_cnn, decontaminate, language_id, line_dedup, lm_trie, minhash_join, packing, quality_cnn
from pipewright.llm import quality_rules, substring_dedup, toxicity


def _bench(spark):
    return spark.createDataFrame([(1, "beta gamma"), (1, "beta gamma"), (None, "id here"), (2, None), (3, ""), (4, "!!")],
                                 "item_id long, text string")


RESULTS = {
    "substring": lambda s, d, l: substring_dedup.substring_dedup(d),
    "toxicity": lambda s, d, l: toxicity.score(d, toxicity.train(d, l)),
    "quality": lambda s, d, l: quality_cnn.score(d, quality_cnn.train(d, l)),
    "lines": lambda s, d, l: line_dedup.line_dedup(d),
    "lm": lambda s, d, l: lm_trie.lm_scores(d),
    "rules": lambda s, d, l: quality_rules.rules(d, l),
    "decontaminate": lambda s, d, l: decontaminate.decontaminate(d, _bench(s)),
    "language": lambda s, d, l: language_id.predict(d, language_id.train(d)),
    "near": lambda s, d, l: minhash_join.near_duplicates(d),
    "pack": lambda s, d, l: packing.pack(d, capacity=100_000),
}


@pytest.mark.parametrize("name", RESULTS)
def test_odd_rows(spark, odd_docs, labels, name):
    assert len(RESULTS[name](spark, odd_docs, labels).collect()) == odd_docs.count()


@pytest.mark.parametrize("name", RESULTS)
def test_empty_tables(spark, odd_docs, labels, name):
    assert RESULTS[name](spark, odd_docs.limit(0), labels.limit(0)).collect() == []


def _stage_inputs(spark, tmp_path, docs, labels):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    _bench(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("empty", [False, True])
def test_stages(spark, odd_docs, labels, tmp_path, empty):
    sf = _stage_inputs(spark, tmp_path, odd_docs, labels)
    docs = odd_docs.limit(0) if empty else odd_docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
            assert dict(out.dtypes) == dict(docs.dtypes), name
        out.write.parquet(f"{tmp_path}/{name}")


def test_values(spark, odd_docs, labels):
    lm = {(r.doc_id, r.n_tokens): r for r in lm_trie.lm_scores(odd_docs).collect()}
    assert lm[(2, 1)].n_tokens == 1 and lm[(7, 30_001)].n_tokens == 30_001
    lang = language_id.predict(odd_docs, None).collect()
    assert {r.lang_pred for r in lang} == {"und"}
    net = language_id.train(odd_docs)
    und = {r.doc_id for r in language_id.predict(odd_docs, net).where("lang_pred = 'und'").collect()}
    assert und == {2, 3, 4, 9, None}
    near = {(r.doc_id, r.component_id, r.kept) for r in minhash_join.near_duplicates(odd_docs).collect()}
    assert {(1, 1, True), (6, 1, False), (2, 2, True), (3, 3, True), (None, None, True)} <= near
    rules = quality_rules.rules(odd_docs, labels).where("doc_id = 7").first()
    assert rules.n_words == 30_000 and rules.n_repeat_words == 30_000 and rules.base_failed and not rules.kept
    lines = line_dedup.line_dedup(odd_docs).where("row.doc_id = 4").first()
    assert lines.n_lines == 3 and lines.text == " \t\n\n"
    d = {r.row.doc_id: r for r in decontaminate.decontaminate(odd_docs, _bench(spark)).collect() if r.row.doc_id}
    assert d[1].clean == "alpha " and d[1]["items"] == ["1"] and d[1].n_hit == 2 and d[1].dropped
    parts = packing.pack(odd_docs, capacity=1000).where("doc_id = 7").orderBy("start").collect()
    assert sum(p.n_tokens for p in parts) == 30_001 and [p.start for p in parts] == list(range(0, 30_001, 1000))


def test_window_starts_cover():
    for size in (0, 1, 255, 256, 257, 448, 449, 1000):
        s = byte_cnn.window_starts(size, 256, 192)
        assert s[0] == 0 and s[-1] + 256 >= size and (len(s) == 1 or s[-2] + 256 < size)


def test_extra_columns_pass(spark, odd_docs):
    out = line_dedup.apply_line_dedup(odd_docs)
    assert out.where(F.col("`a.b`") == "dot").count() == odd_docs.count()


def test_rules_move_no_text(spark, odd_docs, labels):
    """Whole rows meet their verdict where they are read: each row its own, no shuffle and no sort of texts."""
    docs = odd_docs.withColumn("__row", F.lit(1)).withColumn("none", F.lit(None))
    docs = docs.unionByName(docs.withColumn("text", F.concat(F.lit("w"), F.array_join(F.sequence(F.lit(1), F.lit(60)), " w"))))
    out = quality_rules.apply_rules(docs, labels)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Sort" not in plan
    assert out.dtypes == docs.dtypes
    kept = quality_rules.rules(docs, labels).where("kept").select("doc_id", "text_hash")
    want = sorted(map(str, kept.collect()))
    assert sorted(map(str, out.select("doc_id", F.xxhash64("text", "lang").alias("text_hash")).collect())) == want
    assert len(want) >= odd_docs.count()
