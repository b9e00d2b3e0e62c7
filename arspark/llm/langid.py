"""Language identification with averaged subword embeddings and calibrated rejection.

Training takes about ``per_label`` rows of every label (a bounded sample, chosen
by a hash of the id among rows outside the held-out fold). A fifth of it
calibrates: a temperature is fitted to its likelihood, and the rejection bound
is the confidence that all but ``alpha`` of its rightly named documents reach.
Every whole text is scored in tasks that hold only the folded
model (buckets x labels).

Defined results: a null or empty text, or one without a letter, is ``und`` with
score 0 and rejected; rows with a null label are only scored; null ids are in
no fold and never learned from; without labelled rows everything is ``und``;
repeated rows get equal results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arspark.llm.common import released, trim
from arspark.llm.subword import Model, Space, examples, fit, sampled, softmax
from arspark.llm.text import as_bytes, blocks

UND = "und"


def letters_only() -> np.ndarray:
    """Byte table: A-Z lower-cased, a-z and bytes beyond ASCII kept, all else a space."""
    t = np.full(256, 32, dtype=np.uint8)
    t[97:123] = np.arange(97, 123)
    t[65:91] = np.arange(97, 123)
    t[128:] = np.arange(128, 256)
    return t


SPACE = Space(chars=(2, 3, 4), words=(), bits=15, table=letters_only(), squeeze=True)


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
          per_label: int = 800, max_rows: int = 8000, alpha: float = 0.001) -> tuple[Model, float]:
    """Model and rejection bound from rows where ``learn`` holds; never reads more than about ``max_rows`` texts."""
    rows = docs.filter(learn & F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    n_labels = max(1, rows.select(label_col).distinct().count())
    sample = sampled(rows, F.col(label_col), F.col(id_col), max(1, min(per_label, max_rows // n_labels)))
    found = examples(sample.select(F.col(label_col).cast("string").alias("label"), F.col(text_col).cast("string").alias("text")), SPACE)
    model, z, y = fit(found, SPACE)
    del found
    trim()
    p = softmax(z / model.temperature) if len(y) else np.zeros((0, 1))
    right = p.max(axis=1)[p.argmax(axis=1) == y] if len(y) else np.zeros(0)
    return model, float(np.quantile(right, alpha, method="lower")) if len(right) else 0.0


def _predict(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, bound = sent.value
        names = np.array([UND if x is None else x for x in model.labels], dtype=object)
        for batch in batches:
            raw, off = as_bytes(batch.column("text"))
            some = batch.column("some").to_numpy(zero_copy_only=False).astype(bool)
            label, score = np.full(batch.num_rows, UND, dtype=object), np.zeros(batch.num_rows)
            if model.labels != [None]:
                for i, j in blocks(off):
                    p = softmax(model.logits(raw, off, i, j) / model.temperature)
                    k = p.argmax(axis=1)
                    label[i:j] = np.where(some[i:j], names[k], UND)
                    score[i:j] = np.where(some[i:j], p[np.arange(j - i), k], 0.0)
            keep = [c for c in batch.schema.names if c not in ("some", "text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(label, pa.string()), pa.array(score), pa.array((score < bound) | (label == UND))],
                                             [*keep, "lang_pred", "score", "rejected"])
    return run


def identify(docs: DataFrame, model: tuple[Model, float], text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``carry`` of every row, with lang_pred, score (calibrated probability) and rejected."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    text = F.col(text_col).cast("string")
    names = {f"__c{k}": c for k, c in enumerate(carry)}
    rows = docs.select(*(F.col(c).alias(k) for k, c in names.items()), text.alias("text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("some"))
    schema = T.StructType([f for f in rows.schema.fields if f.name not in ("some", "text")]
                          + T.StructType.fromDDL("lang_pred string, score double, rejected boolean").fields)
    out = rows.mapInArrow(released(_predict(sent)), schema)
    return out.select(*(F.col(k).alias(c) for k, c in names.items()), "lang_pred", "score", "rejected")
