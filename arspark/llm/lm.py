"""Masked pseudo-likelihood of documents under a bidirectional window network.

Every word is predicted from the words around it: ``WINDOW`` to the left and
as many to the right, its own place masked. A document's score is the sum of
the log-probabilities of its words.

* One pass counts every word of every document, exactly (words are compared by
  64-bit hashes); the counts are a table that grows with the corpus. The most
  frequent words are classes of their own, the others share the remaining
  classes. A word's probability is that of its class, from the network, times
  its share of the class, from the counts; one occurrence in each shared class
  is set aside for words that were never seen.
* The counts of the ``top`` most frequent words go to every task. Scoring sends
  all other words of a document to their rows of the table by a join, which has
  no hot keys: those words are the rare ones.
* The network (class embeddings by position, one tanh layer, softmax over
  classes) is trained in numpy by the tasks, each over the documents it reads,
  from common starting values; the weights are averaged by words seen, by an
  aggregation whose result is as small as the model. That is one round;
  ``rounds`` of them follow each other. Training predicts every word of every
  document, unless the caller asks for one word in ``stride``.
* Scoring predicts every word of every whole text.

Defined results: a null or empty text has no words, log_prob 0 and a null mean;
repeated rows get equal scores; null ids are scored; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arspark.llm.common import Scratch, released
from arspark.llm.text import NOT_SPACE, Words, as_bytes, blocks

#: Words whose counts every task holds, and distinct words that a counting task holds before it sends them.
TOP, HELD = 1 << 16, 1 << 20
CLASSES = 128
#: Classes of a single word each; the rest, a power of two, share the other words.
OWN = 96
WINDOW = 2
DIM = 16
BATCH = 512
#: Bounds of output weights and biases: with them exp() can't overflow.
MOST_WEIGHT, MOST_BIAS = 3.5, 20.0


class Vocabulary:
    """Classes of words, and counts of the most frequent ones.

    ``words`` come by falling count; ``rest`` holds the occurrences of all other words by class.
    """

    def __init__(self, words: np.ndarray, counts: np.ndarray, rest: np.ndarray):
        own = np.sort(words[:OWN])
        self.own = np.append(own, own[-1:]) if len(own) else np.zeros(1, np.uint64)
        self.own_class = np.full(len(self.own), OWN)
        self.own_class[:len(own)] = np.argsort(words[:OWN])
        order = np.argsort(words)
        self.words = words[order] if len(words) else np.zeros(1, np.uint64)
        self.log_count = np.log(counts[order]) if len(words) else np.zeros(1)
        total = rest + np.bincount(self.class_of(words), weights=counts, minlength=CLASSES)
        #: Logarithm of what a class's words share among them.
        self.log_total = np.where(np.arange(CLASSES) < OWN, np.log(np.maximum(total, 1)), np.log(total + 1))
        self.prior = (total + 1) / (total + 1).sum()

    def class_of(self, words: np.ndarray) -> np.ndarray:
        c = OWN + (words & np.uint64(CLASSES - OWN - 1)).astype(np.int64)
        k = np.minimum(np.searchsorted(self.own, words), len(self.own) - 1)
        single = (self.own[k] == words) & (self.own_class[k] < OWN)
        c[single] = self.own_class[k[single]]
        return c

    def log_share(self, words: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log of each word's share of its class, and whether its count is here; where it isn't, that of a count of one."""
        k = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        known = self.words[k] == words
        return np.where(known, self.log_count[k], 0.0) - self.log_total[c], known


def start(vocabulary: Vocabulary, seed: int = 5) -> np.ndarray:
    """Starting weights, one vector; the biases are the log class frequencies."""
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 0.3, (2 * WINDOW, CLASSES + 1, DIM))
    out = rng.normal(0, 0.1, (DIM, CLASSES))
    bias = np.clip(np.log(vocabulary.prior), -MOST_BIAS, MOST_BIAS)
    return np.concatenate([e.ravel(), np.zeros(DIM), out.ravel(), bias]).astype(np.float32)


def _parts(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = 2 * WINDOW * (CLASSES + 1) * DIM
    m = n + DIM
    k = m + DIM * CLASSES
    return weights[:n].reshape(2 * WINDOW, CLASSES + 1, DIM), weights[n:m], weights[m:k].reshape(DIM, CLASSES), weights[k:]


def contexts(c: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Classes around each word, ``CLASSES`` beyond the ends of its text: (2 * WINDOW, words)."""
    gap = WINDOW
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.arange(len(c)) + gap * (row + 1)
    wide = np.full(len(c) + gap * (len(first) + 1), CLASSES, dtype=np.int64)
    wide[at] = c
    return np.stack([wide[at + d] for d in (*range(-WINDOW, 0), *range(1, WINDOW + 1))])


def train_step(weights: np.ndarray, around: np.ndarray, c: np.ndarray, rate: float) -> None:
    """One step of gradient descent on a batch, in place."""
    e, hidden_bias, out, bias = _parts(weights)
    h = np.tanh(sum(e[k][around[k]] for k in range(2 * WINDOW)) + hidden_bias)
    p = np.exp(h @ out + bias)
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(len(c)), c] -= 1
    p *= np.float32(rate / len(c) ** 0.5)
    back = (p @ out.T) * (1 - h * h)
    out -= h.T @ p
    np.clip(out, -MOST_WEIGHT, MOST_WEIGHT, out=out)
    bias -= p.sum(axis=0)
    np.clip(bias, -MOST_BIAS, MOST_BIAS, out=bias)
    hidden_bias -= back.sum(axis=0)
    for k in range(2 * WINDOW):
        place = np.zeros((CLASSES + 1, len(c)), dtype=np.float32)
        place[around[k], np.arange(len(c))] = 1
        e[k] -= place @ back


def log_probs(weights: np.ndarray, around: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Log-probability of each word's class."""
    e, hidden_bias, out, bias = _parts(weights)
    got = np.empty(len(c), dtype=np.float64)
    for a in range(0, len(c), 4096):
        s = slice(a, a + 4096)
        h = np.tanh(sum(e[k][around[k, s]] for k in range(2 * WINDOW)) + hidden_bias)
        z = h @ out
        z += bias
        own = z[np.arange(len(z)), c[s]]
        np.exp(z, out=z)
        got[s] = own - np.log(z.sum(axis=1))
    return got


def _words(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, Words]]:
    raw, off = as_bytes(batch.column(column))
    for i, j in blocks(off, 1 << 20):
        yield i, j, Words(raw, off, i, j, NOT_SPACE)


def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of distinct words out of several such lists."""
    words, counts = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(words)
    words, counts = words[order], counts[order]
    head = np.flatnonzero(np.append(True, words[1:] != words[:-1]))[:len(words)]
    return words[head], np.add.reduceat(counts, head) if len(head) else counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def flush() -> pa.RecordBatch:
        words, counts = _added(held)
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], ["word", "n"])

    for batch in batches:
        for _, _, w in _words(batch, "text"):
            held.append(np.unique(w.hash, return_counts=True))
            size += len(held[-1][0])
            if size > HELD:
                held = [_added(held)]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield flush()
                    held, size = [], 0
    if held:
        yield flush()


def _train(sent, stride: int, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights = sent.value[0], sent.value[1].copy()
        seen, waiting = 0, []
        for batch in batches:
            for i, _, w in _words(batch, "text"):
                c = vocabulary.class_of(w.hash)
                around = contexts(c, w.first)
                # every stride-th word of the block, the place moving on with the documents read
                at = np.arange((seen + i) % stride, len(c), stride)
                seen += len(at)
                waiting.append((around[:, at], c[at]))
                if sum(len(x[1]) for x in waiting) < BATCH:
                    continue
                around, c = np.concatenate([x[0] for x in waiting], axis=1), np.concatenate([x[1] for x in waiting])
                full = len(c) // BATCH * BATCH
                waiting = [(around[:, full:], c[full:])]
                order = np.random.default_rng(full).permutation(full)
                for a in range(0, full, BATCH):
                    part = order[a:a + BATCH]
                    train_step(weights, around[:, part], c[part], rate)
        if waiting and len(waiting[0][1]):
            train_step(weights, np.concatenate([x[0] for x in waiting], axis=1), np.concatenate([x[1] for x in waiting]), rate)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(weights))), pa.array(weights.astype(np.float64) * seen), pa.array(np.full(len(weights), seen, np.float64))],
                                             ["k", "value", "seen"])
    return run


def fit(docs: DataFrame, text_col: str = "text", rounds: int = 1, stride: int = 1, rate: float = 0.02,
        top: int = TOP) -> tuple[Vocabulary, np.ndarray, DataFrame | None]:
    """Vocabulary and weights learned from all of ``docs``, and (word, n) of the words beyond the most frequent ones, ``top`` at most, if there are any."""
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    # kept: scoring joins it
    counts = Scratch(spark, "lm-words").save(texts.mapInArrow(released(_count), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), keep=True)
    # words by the seven leading binary digits of their count: a few thousand rows at most
    low = F.expr("shiftright(n, greatest(length(bin(n)) - 7, 0))") * F.expr("shiftleft(1L, greatest(length(bin(n)) - 7, 0))")
    held, least = 0, None
    for r in counts.groupBy(low.alias("low")).agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("low")).collect():
        held += r["words"]
        if held > top:
            break
        least = r["low"]
    most = [] if least is None else counts.filter(F.col("n") >= least).orderBy(F.desc("n"), "word").collect()  # ``top`` rows at most
    rest, by_class = None, np.zeros(CLASSES)
    if held > top:
        rest = counts if least is None else counts.filter(F.col("n") < least)
        for r in rest.groupBy(F.col("word").bitwiseAND(CLASSES - OWN - 1).alias("k")).agg(F.sum("n").alias("n")).collect():
            by_class[OWN + r["k"]] = r["n"]
    vocabulary = Vocabulary(np.array([r["word"] for r in most], np.int64).view(np.uint64), np.array([r["n"] for r in most], np.int64), by_class)
    weights = start(vocabulary)
    for k in range(rounds):
        sent = spark.sparkContext.broadcast((vocabulary, weights))
        got = texts.mapInArrow(released(_train(sent, stride, rate / (k + 1))), "k long, value double, seen double")
        # as many rows as the model has weights
        mean = got.groupBy("k").agg((F.sum("value") / F.sum("seen")).alias("value")).collect()
        if mean:
            weights = np.zeros_like(weights)
            for r in mean:
                weights[r["k"]] = r["value"]
    return vocabulary, weights, rest


def _score(sent):
    """A row for each document, and one with its key for each of its words whose count is in the table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights = sent.value
        after = TaskContext.get().partitionId() << 40
        for batch in batches:
            n, total = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows)
            rows, words, times = [], [], []
            for i, j, w in _words(batch, "text"):
                c = vocabulary.class_of(w.hash)
                share, known = vocabulary.log_share(w.hash, c)
                p = log_probs(weights, contexts(c, w.first), c) + share
                row = w.rows_of()
                n[i:j] = np.diff(w.first)
                total[i:j] = np.bincount(row, weights=p, minlength=j - i)
                row, word = row[~known] + i, w.hash[~known]
                order = np.lexsort((word, row))
                row, word = row[order], word[order]
                head = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (word[1:] != word[:-1]))[:len(row)])
                rows.append(row[head])
                words.append(word[head].view(np.int64))
                times.append(np.diff(np.append(head, len(row))))
            keep = [c for c in batch.schema.names if c != "text"]
            names = [*keep, "key", "n_words", "log_prob", "word", "times"]
            key = after + np.arange(batch.num_rows)
            after += batch.num_rows
            none = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(key), pa.array(n), pa.array(total), none, none], names)
            if rows and sum(map(len, rows)):
                row, word, time = (np.concatenate(x) for x in (rows, words, times))
                yield pa.RecordBatch.from_arrays([*(pa.nulls(len(row), batch.column(c).type) for c in keep), pa.array(key[row]), pa.nulls(len(row), pa.int64()),
                                                  pa.nulls(len(row), pa.float64()), pa.array(word), pa.array(time)], names)
    return run


def score(docs: DataFrame, model: tuple[Vocabulary, np.ndarray, DataFrame | None], text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``carry`` of every row, with n_words, log_prob (the sum) and mean_log_prob."""
    spark = docs.sparkSession
    vocabulary, weights, rest = model
    sent = spark.sparkContext.broadcast((vocabulary, weights))
    names = {f"__c{k}": c for k, c in enumerate(carry)}
    rows = docs.select(*(F.col(c).alias(k) for k, c in names.items()), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields if f.name != "text"]
                          + T.StructType.fromDDL("key long, n_words long, log_prob double, word long, times long").fields)
    found = rows.mapInArrow(released(_score(sent)), schema)
    if rest is None:
        out = found.filter("word IS NULL")
    else:
        # saved once: keys are those of one reading
        found = Scratch(spark, "lm-score").save(found, keep=True)
        more = found.filter("word IS NOT NULL").select("key", "word", "times").join(rest, "word")
        more = more.groupBy("key").agg(F.sum(F.col("times") * F.log("n")).alias("more"))
        out = found.filter("word IS NULL").join(more, "key", "left").withColumn("log_prob", F.col("log_prob") + F.coalesce("more", F.lit(0.0)))
    mean = F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words"))
    return out.select(*(F.col(k).alias(c) for k, c in names.items()), "n_words", "log_prob", mean.alias("mean_log_prob"))
