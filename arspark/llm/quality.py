"""Document quality with supervised word and character n-gram embeddings.

The learned vectors of hashed words, word pairs and byte n-grams (case kept:
shouting and markup are signals) are averaged over the document; a softmax
gives the probability of label 1. Training takes about ``per_label`` labelled
rows of each label outside the held-out fold, a bounded sample; its ids are
broadcast (at most ``2 * per_label`` in expectation). Every whole text is
scored in tasks that hold only the folded model.

Defined results: null and empty texts have no features and get the score of
the bias alone; unlabelled rows are only scored; null ids are never learned
from; a document labelled twice is learned twice; without labels every score
is 0.5; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arspark.llm.common import released
from arspark.llm.subword import Model, Space, examples, fit, sampled, softmax
from arspark.llm.text import as_bytes, blocks

SPACE = Space(chars=(2, 3), words=(1, 2), bits=15, table=np.arange(256, dtype=np.uint8))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          per_label: int = 3000) -> Model:
    """Model from ``labels`` (columns ``id_col`` and ``label_col`` of 0 or 1), already limited to the rows to learn from."""
    rows = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    rows = rows.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("label"))
    sample = sampled(rows, F.col("label"), F.col("__id"), per_label)
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(sample), "__id")
    model, _, _ = fit(examples(texts, SPACE), SPACE)
    return model


def _score(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            raw, off = as_bytes(batch.column("text"))
            score = np.full(batch.num_rows, 0.5)
            if 1 in model.labels:
                for i, j in blocks(off):
                    score[i:j] = softmax(model.logits(raw, off, i, j) / model.temperature)[:, model.labels.index(1)]
            elif model.labels == [0]:
                score[:] = 0.0
            keep = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(score)], [*keep, "score"])
    return run


def score(docs: DataFrame, model: Model, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``carry`` of every row, with score: the probability of label 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = {f"__c{k}": c for k, c in enumerate(carry)}
    rows = docs.select(*(F.col(c).alias(k) for k, c in names.items()), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([f for f in rows.schema.fields if f.name != "text"] + [T.StructField("score", T.DoubleType())])
    out = rows.mapInArrow(released(_score(sent)), schema)
    return out.select(*(F.col(k).alias(c) for k, c in names.items()), "score")
