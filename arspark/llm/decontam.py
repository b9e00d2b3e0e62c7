"""Benchmark decontamination: a prefix-filtered containment join of documents with item windows.

A window is ``window`` consecutive words of a benchmark item (the whole item
if it has fewer, but not none). A document word inside any occurrence of a
window is hit.

A window lies in a document only if all its shingles (runs of up to
``SHINGLE`` words) do, so it is enough to look for one of them: its prefix.

1. One pass counts how often each benchmark shingle occurs in all documents.
2. Shingles are ordered by rarity; each window's prefix is its rarest shingle,
   kept with its position in the window. Windows that share a prefix shingle at
   one position and are equal are one window.
3. A second pass joins document shingles with the prefixes. The position of the
   prefix in the window fixes where the window would begin, so candidates that
   would begin before the document or end after it are dropped, and the rest
   are verified word by word (64-bit hashes) over the item-sized window.

Documents are never shuffled or collected. The benchmark goes to the tasks in
blocks of at most ``block_words`` words (about 100 bytes a word), whatever its
size: each block is one more pass over the same rows, which carry the hits found
so far and are written down between two blocks, so a large benchmark costs more
passes, not more memory.

Defined results: a null or empty text has no words, so nothing is hit and it
is not contaminated; null or empty items have no windows; equal items are all
reported; repeated documents are judged one by one; an empty table on either
side gives rows without hits, or none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arspark.llm.common import Scratch, released
from arspark.llm.text import ALNUM, Words, as_bytes, blocks, grams

#: Words of a shingle. A window of fewer words is its own shingle.
SHINGLE = 4
#: Slots of the table that tells most absent shingles without a search.
FILTER_BITS = 22


class Index:
    """The windows of a block of items, and the shingles in them."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        col = pa.array([t for _, t in items], pa.string())
        raw, off = as_bytes(col)
        w = Words(raw, off, 0, len(items), ALNUM) if items else None
        self.items = [i for i, _ in items]
        found: dict[int, dict[bytes, list[int]]] = {}
        for k in range(len(items)):
            h = w.hash[w.first[k]:w.first[k + 1]]
            size = min(window, len(h))
            if size:
                for s in range(len(h) - size + 1):
                    found.setdefault(size, {}).setdefault(h[s:s + size].tobytes(), []).append(k)
        #: by window size: (words of each distinct window, items it stands in)
        self.windows = {size: (np.frombuffer(b"".join(d), dtype=np.uint64).reshape(-1, size), [sorted(set(v)) for v in d.values()])
                        for size, d in sorted(found.items())}
        self.shingles = {n: np.unique(np.concatenate([_rows(x, n).ravel() for x, _ in group]))
                         for n, group in self._by_shingle().items()}
        self.prefix: dict[int, tuple] = {}

    def _by_shingle(self) -> dict[int, list]:
        out: dict[int, list] = {}
        for size, group in self.windows.items():
            out.setdefault(min(SHINGLE, size), []).append(group)
        return out

    def choose(self, counts: dict[int, np.ndarray]) -> None:
        """Take each window's rarest shingle (ties: the smaller hash) as its prefix."""
        for size, (x, _) in self.windows.items():
            n = min(SHINGLE, size)
            g = _rows(x, n)
            seen = counts[n][np.searchsorted(self.shingles[n], g)]
            order = np.lexsort((g, seen), axis=1)
            at = order[:, 0]
            rarest = g[np.arange(len(g)), at]
            by = np.argsort(rarest, kind="stable")
            self.prefix[size] = (rarest[by], at[by], by)


def _rows(x: np.ndarray, n: int) -> np.ndarray:
    """Shingles of each window: one row a window."""
    return np.stack([grams(np.ascontiguousarray(r), n) for r in x]) if len(x) else np.zeros((0, 1), np.uint64)


def _maybe(values: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << FILTER_BITS, dtype=bool)
    table[values >> np.uint64(64 - FILTER_BITS)] = True
    return table


def _inside(w: Words, at: np.ndarray, n: int) -> np.ndarray:
    """Of word positions, those where n words follow in the same row; and their rows."""
    row = np.searchsorted(w.first, at, "right") - 1
    return at + n <= w.first[row + 1], row


def _count(indexes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, total = indexes.value, {}
        maybe = {n: _maybe(s) for n, s in index.shingles.items()}
        for batch in batches:
            raw, off = as_bytes(batch.column(0))
            for i, j in blocks(off):
                w = Words(raw, off, i, j, ALNUM)
                for n, s in index.shingles.items():
                    g = grams(w.hash, n)
                    at = np.flatnonzero(maybe[n][g >> np.uint64(64 - FILTER_BITS)])
                    at = at[_inside(w, at, n)[0]]
                    k = np.searchsorted(s, g[at])
                    hit = (k < len(s)) & (s[np.minimum(k, len(s) - 1)] == g[at])
                    total[n] = total.get(n, 0) + np.bincount(k[hit], minlength=len(s))
        for n, c in total.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), n, np.int32)), pa.array(at), pa.array(c[at].astype(np.int64))], ["n", "shingle", "seen"])
    return run


def _search(indexes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = indexes.value
        maybe = {size: _maybe(p[0]) for size, p in index.prefix.items()}
        for batch in batches:
            n_rows = batch.num_rows
            raw, off = as_bytes(batch.column("text"))
            hits, items = batch.column("hits").to_pylist(), batch.column("items").to_pylist()
            words = np.zeros(n_rows, dtype=np.int64)
            for i, j in blocks(off):
                w = Words(raw, off, i, j, ALNUM)
                words[i:j] = np.diff(w.first)
                for size, (rarest, place, window) in index.prefix.items():
                    n = min(SHINGLE, size)
                    g = grams(w.hash, n)
                    at = np.flatnonzero(maybe[size][g >> np.uint64(64 - FILTER_BITS)])
                    lo, hi = np.searchsorted(rarest, g[at], "left"), np.searchsorted(rarest, g[at], "right")
                    many = hi - lo
                    at = np.repeat(at, many)
                    k = np.repeat(lo, many) + np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
                    # the window would begin `place` words before: it must lie inside the shingle's own row
                    row = np.searchsorted(w.first, at, "right") - 1
                    begin = at - place[k]
                    fits = (begin >= w.first[row]) & (begin + size <= w.first[row + 1])
                    begin, k, row = begin[fits], window[k[fits]], row[fits]
                    x, held = index.windows[size]
                    same = np.ones(len(begin), dtype=bool)
                    for c in range(size):  # exact, word by word
                        left = np.flatnonzero(same)
                        same[left] = w.hash[begin[left] + c] == x[k[left], c]
                    for b, q, r in zip((begin[same] - w.first[row[same]]).tolist(), k[same].tolist(), row[same].tolist()):
                        hits[i + r].append([b, b + size])
                        items[i + r].extend(index.items[t] for t in held[q])
                for r in range(i, j):  # a passage that recurs is kept once
                    if hits[r]:
                        hits[r], items[r] = _merged(hits[r]), sorted(set(items[r]))
            names = [c for c in batch.schema.names if c not in ("n_words", "hits", "items")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(words), pa.array(hits, pa.list_(pa.list_(pa.int64()))) if n_rows else pa.array([], pa.list_(pa.list_(pa.int64()))),
                                              pa.array(items, pa.list_(pa.string()))], [*names, "n_words", "hits", "items"])
    return run


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _report(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("n_words").to_numpy(zero_copy_only=False)
            hits, items = batch.column("hits").to_pylist(), batch.column("items").to_pylist()
            n_hit = np.array([sum(b - a for a, b in h) for h in hits], dtype=np.int64)
            sha = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items]
            drop = ("n_words", "hits", "items") if keep_text else ("n_words", "hits", "items", "text")
            names = [c for c in batch.schema.names if c not in drop]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(words), pa.array(n_hit), pa.array([len(x) for x in items], pa.int64()),
                 pa.array(sha, pa.string()), pa.array((n_hit > 0) & (20 * n_hit >= words)), batch.column("hits"), batch.column("items")],
                [*names, "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans", "items"])
    return run


def _blocks_of(items: DataFrame, item_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[str, str]]]:
    """Items in blocks of at most ``block_words`` words, or one item; the driver holds one partition's items at a time."""
    block, words = [], 0
    rows = items.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t"))
    for r in rows.filter("t IS NOT NULL").toLocalIterator():
        n = len(r["t"]) // 2 + 1
        if block and words + n > block_words:
            yield block
            block, words = [], 0
        block.append((r["i"] or "", r["t"]))
        words += n
    if block:
        yield block


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = 13, block_words: int = 2_000_000, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256, contaminated, spans, items.

    ``spans``: hit word ranges [from, to); ``items``: ids (as text) of items
    with occurring windows; ``items_sha256``: of those ids, sorted and joined
    with commas; ``contaminated``: at least one word in twenty is hit. Columns
    of ``docs`` named in ``carry`` are returned too, text included if named.
    """
    spark = docs.sparkSession
    keep_text = text_col in carry
    extra = [c for c in carry if c != text_col]
    extra = [c for c in extra if c != id_col]
    rows = docs.select(F.col(id_col).alias("__id"), *(F.col(c).alias(f"__c{k}") for k, c in enumerate(extra)),
                       F.col(text_col).cast("string").alias("text"))
    base = rows.schema
    rows = rows.withColumn("n_words", F.lit(0).cast("long")).withColumn("hits", F.array().cast("array<array<bigint>>")).withColumn("items", F.array().cast("array<string>"))
    searched, scratch, steps = False, Scratch(spark, "decontam"), []
    for block in chain(_blocks_of(items, item_col, item_text_col, block_words), [[]]):  # words are counted without items too
        index = Index(block, window)
        if not index.windows and searched:
            continue
        searched = True
        sent = spark.sparkContext.broadcast(index)
        seen = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(released(_count(sent)), "n int, shingle long, seen long")
        counts = {n: np.zeros(len(s), np.int64) for n, s in index.shingles.items()}
        # at most one row for each shingle of the block
        for r in seen.groupBy("n", "shingle").agg(F.sum("seen").alias("seen")).toLocalIterator():
            counts[r["n"]][r["shingle"]] = r["seen"]
        index.choose(counts)
        if steps:  # one index is alive in a task at a time: what the block before found is written down
            rows = scratch.save(rows.mapInArrow(released(steps.pop()), rows.schema), keep=True)
        steps.append(_search(spark.sparkContext.broadcast(index)))
    kept = [f for f in base.fields if keep_text or f.name != "text"]
    schema = T.StructType([*kept, *T.StructType.fromDDL(
        "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<array<long>>, items array<string>").fields])
    last, report = steps.pop(), _report(keep_text)
    out = rows.mapInArrow(released(lambda batches: report(last(batches))), schema)  # one step: texts go to Python once
    names = {"__id": id_col, "text": text_col} | {f"__c{k}": c for k, c in enumerate(extra)}
    return out.select(*(F.col(f.name).alias(names.get(f.name, f.name)) for f in schema.fields))
