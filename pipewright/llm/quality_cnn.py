"""Quality classifier: byte CNN over overlapping chunks that cover the whole document.

Trained on at most ``TRAIN_ROWS`` labelled documents (smallest hashes of the
doc_id, so a sample over the whole table) whose crc32(doc_id) mod ``folds`` is
not 0; nothing but text bytes enters a score.

Edge cases: null or empty text is one chunk of zeros and is scored like any
other; a doc_id labelled more than once gives a training row each; rows with a null
label or without id are not trained on; without any training row every score is 0.5; repeated rows are
scored each; extra columns are ignored whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pipewright.llm.byte_cnn import ByteCnn, scorer, training_windows
from pipewright.llm.common import fold

LENGTH, STEP = 256, 192
TRAIN_ROWS = 5000
EPOCHS = 8
FOLDS = 5


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, folds: int = FOLDS) -> ByteCnn | None:
    rows = labels.where((fold(F.col("doc_id"), folds) != 0) & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    rows = rows.select(F.col("doc_id").alias("__id"), "quality").orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(train_rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(rows), F.col("doc_id") == F.col("__id")).select("doc_id", "quality", "text")
    seen = training_windows(F.col("text"), sample, LENGTH, STEP).orderBy("doc_id", "quality", "windows").limit(2 * train_rows).collect()
    if len({r["quality"] for r in seen}) < 2:
        return None
    net = ByteCnn([0, 1], LENGTH, STEP, widths=(7,), filters=24, hidden=16)
    return net.fit([r["windows"] for r in seen], [r["quality"] for r in seen], EPOCHS)


def score(docs: DataFrame, net: ByteCnn | None) -> DataFrame:
    """doc_id and ``score`` (probability of label 1) of every row; no shuffle."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if net is None:
        return slim.select("doc_id", F.lit(0.5).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(net)
    return slim.mapInArrow(scorer(shared, slim.columns), "doc_id long, probs array<double>").select(
        "doc_id", F.col("probs")[1].alias("score"))
