"""Language identification: byte CNN with filters of several widths over fixed-length windows.

Trained on at most ``TRAIN_ROWS`` documents (smallest hashes of the doc_id), and
at most ``LANG_ROWS`` of each language so that a rare one is learned too, with a language whose crc32(doc_id) mod ``folds`` is not ``held``; nothing but
text bytes enters a prediction, which averages over all windows of the text.

Edge cases: null text, or text without a letter, is 'und' with score 0; a
table without any training row predicts 'und' throughout; with one language
alone that language is predicted; rows without id take part in no training;
repeated rows are scored each; extra columns are ignored whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pipewright.llm.byte_cnn import ByteCnn, scorer, training_windows
from pipewright.llm.common import fold

LENGTH = 256
TRAIN_ROWS = 3000
LANG_ROWS = 200
EPOCHS = 5
FOLDS, HELD = 4, 2


def train(docs: DataFrame, train_rows: int = TRAIN_ROWS, folds: int = FOLDS, held: int = HELD) -> ByteCnn | None:
    rows = docs.where((fold(F.col("doc_id"), folds) != held) & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()
                      & F.col("text").rlike(r"\p{L}"))
    hashed = rows.select(F.col("doc_id").alias("__id"), "lang", F.xxhash64("doc_id").alias("__h"))
    first = hashed.orderBy("__h", "__id").limit(train_rows).select("__id")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("__h", "__id"))
    each = hashed.withColumn("__n", nth).where(F.col("__n") <= LANG_ROWS).select("__id")
    ids = first.union(each).distinct()
    bound = 2 * ids.count()
    sample = rows.select("doc_id", "lang", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("__id"))
    sample = sample.select("doc_id", "lang", "text")
    seen = training_windows(F.col("text"), sample, LENGTH, LENGTH).orderBy("doc_id", "lang", "windows").limit(bound).collect()
    if not seen:
        return None
    langs = sorted({r["lang"] for r in seen})
    net = ByteCnn(langs, LENGTH, LENGTH, widths=(2, 3, 5), filters=12)
    return net.fit([r["windows"] for r in seen], [langs.index(r["lang"]) for r in seen], EPOCHS)


def predict(docs: DataFrame, net: ByteCnn | None) -> DataFrame:
    """doc_id, lang_pred and score of every row; no shuffle."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    if net is None:
        return slim.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(net)
    p = slim.mapInArrow(scorer(shared, slim.columns), "doc_id long, letters boolean, probs array<double>")
    best = F.array_max("probs")
    name = F.element_at(F.array(*[F.lit(c) for c in net.classes]), F.array_position("probs", best).cast("int"))
    return p.select("doc_id", F.when(F.col("letters"), name).otherwise("und").alias("lang_pred"),
                    F.when(F.col("letters"), best).otherwise(0.0).alias("score"))
