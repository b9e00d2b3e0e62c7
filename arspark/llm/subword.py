"""Averaged hashed subword embeddings with a linear softmax, in numpy.

A document is the mean of the learned vectors of its features (hashed n-grams);
a softmax over a linear map of that mean gives class probabilities. Training is
stochastic gradient descent, one document a step. For prediction the map is
folded into the vectors, so a feature costs one look-up of a row of class
scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arspark.llm.common import Scratch, released
from arspark.llm.text import NOT_SPACE, Words, as_bytes, grams, mix

PAD = 4


def padded(raw: np.ndarray, off: np.ndarray, i: int, j: int, table: np.ndarray, squeeze: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows [i, j) mapped by ``table``, each after PAD spaces, and their begin and end in that buffer.

    ``squeeze``: runs of spaces become one.
    """
    raw, off = table[raw[off[i]:off[j]]], off[i:j + 1] - off[i]
    if squeeze and len(raw):
        keep = raw != 32
        keep[1:] |= raw[:-1] != 32
        off = np.concatenate([[0], np.cumsum(keep)])[off]
        raw = raw[keep]
    lens = np.diff(off)
    begin = np.cumsum(lens + PAD) - lens
    out = np.full(int(lens.sum()) + PAD * (len(lens) + 2), 32, dtype=np.uint8)
    for b, n, a in zip(begin.tolist(), lens.tolist(), off.tolist()):
        out[b:b + n] = raw[a:a + n]
    return out, begin, begin + lens


def char_grams(buf: np.ndarray, begin: np.ndarray, end: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each n-gram (n up to 4) from one byte before a row to its last byte; first gram of each row, with the total."""
    h = buf[:len(buf) - 3].astype(np.uint32)
    for k in range(1, n):
        h |= buf[k:len(buf) - 3 + k].astype(np.uint32) << np.uint32(8 * k)
    h *= np.uint32(2654435761)
    h ^= h >> np.uint32(15)
    h *= np.uint32(2246822519 + 2 * n)
    h >>= np.uint32(32 - bits)
    # gaps between rows hold PAD spaces: drop the windows that lie in them
    size = np.where(end > begin, end - begin + 1, 0)
    first = np.zeros(len(size) + 1, dtype=np.int64)
    np.cumsum(size, out=first[1:])
    at = np.arange(first[-1]) + np.repeat(begin - 1 - first[:-1], size)
    return h[at], first


@dataclass
class Space:
    """Which features a model has: byte n-grams over ``table``-mapped text, and word n-grams.

    Every kind of feature has ``2**bits`` vectors of its own and is averaged by
    itself. A pair of equal words is one feature whatever the word.
    """

    chars: tuple[int, ...]
    words: tuple[int, ...]
    bits: int
    table: np.ndarray
    squeeze: bool = False

    @property
    def kinds(self) -> int:
        return len(self.chars) + len(self.words)

    def features(self, raw: np.ndarray, off: np.ndarray, i: int, j: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each kind: bucket of each feature (offset by kind), and the first feature of each row."""
        kind = 0
        if self.chars:
            buf, begin, end = padded(raw, off, i, j, self.table, self.squeeze)
            for n in self.chars:
                h, first = char_grams(buf, begin, end, n, self.bits)
                yield h.astype(np.int64) + (kind << self.bits), first
                kind += 1
        if self.words:
            w = Words(raw, off, i, j, NOT_SPACE, np.arange(256, dtype=np.uint8))
            count = np.diff(w.first)
            for n in self.words:
                size = np.maximum(count - n + 1, 0)
                first = np.zeros(len(size) + 1, dtype=np.int64)
                np.cumsum(size, out=first[1:])
                g = mix(w.hash) if n == 1 else grams(w.hash, n)
                if n == 2 and len(w.hash) > 1:
                    g[w.hash[1:] == w.hash[:-1]] = 0
                at = np.arange(first[-1]) + np.repeat(w.first[:-1] - first[:-1], size)
                yield (g[at] >> np.uint64(64 - self.bits)).astype(np.int64) + (kind << self.bits), first
                kind += 1


@dataclass
class Model:
    space: Space
    labels: list
    scores: np.ndarray  # (features, classes), the linear map folded in
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, raw: np.ndarray, off: np.ndarray, i: int, j: int) -> np.ndarray:
        """Class scores of rows [i, j), before the temperature."""
        out = np.tile(self.bias.astype(np.float64), (j - i, 1))
        for h, first in self.space.features(raw, off, i, j):
            if not len(h):
                continue
            rows, count = np.repeat(np.arange(j - i), np.diff(first)), np.maximum(np.diff(first), 1)
            for c in range(len(self.labels)):
                out[:, c] += np.bincount(rows, weights=self.scores[h, c], minlength=j - i) / count
        return out


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _examples(space: Space):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = as_bytes(batch.column("text"))
            idx, weight = [], []
            for r in range(batch.num_rows):
                f, w = [], []
                for h, _ in space.features(raw, off, r, r + 1):
                    u, c = np.unique(h, return_counts=True)
                    f.append(u.astype(np.int32))
                    w.append((c / max(1, len(h))).astype(np.float32))
                idx.append(np.concatenate(f).tobytes())
                weight.append(np.concatenate(w).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(idx, pa.binary()), pa.array(weight, pa.binary())], ["label", "idx", "weight"])
    return run


def sampled(rows: DataFrame, label: Column, key: Column, per_label: int) -> DataFrame:
    """About ``per_label`` rows of each label, chosen by a hash of ``key``; all rows of a rarer label."""
    counts = {r["l"]: r["n"] for r in rows.groupBy(label.alias("l")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return rows.limit(0)
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, per_label / n))])
    return rows.filter(F.pmod(F.xxhash64(key, F.lit(7)), F.lit(1 << 30)) < share[label] * float(1 << 30))


def examples(sample: DataFrame, space: Space) -> list[tuple]:
    """(label, feature indexes, weights) of a bounded sample with columns label and text, in a fixed order.

    The rows are made side by side and saved; the driver's JVM holds those of one partition of the saved table at a time.
    """
    kind = sample.schema["label"].dataType.simpleString()
    rows = sample.select("label", "text").mapInArrow(released(_examples(space)), f"label {kind}, idx binary, weight binary")
    with Scratch(sample.sparkSession, "examples") as scratch:
        found = [tuple(r) for r in scratch.save(rows).toLocalIterator()]
    found.sort(key=lambda r: (str(r[0]), r[1], r[2]))
    return [(label, np.frombuffer(idx, np.int32), np.frombuffer(weight, np.float32)) for label, idx, weight in found]


def fit(found: list[tuple], space: Space, dim: int = 16, epochs: int = 5, rate: float = 0.5, seed: int = 11, held: float = 0.2) -> tuple[Model, np.ndarray, np.ndarray]:
    """Train on 1 - ``held`` of the examples; calibrate the temperature on the rest.

    Returns the model and the rest's logits and label numbers. Without examples the model has one label, None.
    """
    labels = sorted({x[0] for x in found}, key=str) or [None]
    rng = np.random.default_rng(seed)
    number = {v: k for k, v in enumerate(labels)}
    order = rng.permutation(len(found))
    rest, train = np.split(order, [int(len(found) * held)])
    vectors = rng.uniform(-1 / dim, 1 / dim, (space.kinds << space.bits, dim)).astype(np.float32)
    out = rng.normal(0, 0.1, (dim, len(labels))).astype(np.float32)
    bias = np.zeros(len(labels), dtype=np.float32)
    step, total = 0, max(1, epochs * len(train))
    for _ in range(epochs):
        for t in rng.permutation(train):
            label, idx, weight = found[t]
            lr = np.float32(rate * (1 - step / total))
            step += 1
            x = weight @ vectors[idx]
            g = softmax(x @ out + bias)
            g[number[label]] -= 1
            back = out @ g
            out -= lr * np.outer(x, g)
            bias -= np.float32(0.1) * lr * g
            if len(idx):  # normalized step: it moves the document's mean by lr * back, however many features share it
                vectors[idx] -= (lr / (weight @ weight) * weight)[:, None] * back
    model = Model(space, labels, vectors @ out, bias)
    z = np.array([w @ model.scores[i] + bias for _, i, w in (found[t] for t in rest)], dtype=np.float64).reshape(-1, len(labels))
    y = np.array([number[found[t][0]] for t in rest], dtype=np.int64)
    if len(y):
        grid = 2.0 ** np.arange(-2, 4.25, 0.25)
        model.temperature = float(min(grid, key=lambda t: -np.log(softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean()))
    return model, z, y
