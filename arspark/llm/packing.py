"""Best-fit-decreasing packing of tokenized documents into fixed-length sequences.

1. Tasks tokenize whole texts and cut those over ``max_tokens`` into pieces.
   Each piece is numbered among the pieces of its length in its task; the
   pieces are saved.
2. Pieces of one length are interchangeable, so the decision needs only how
   many pieces each length has: at most ``max_tokens`` numbers, whatever the
   corpus. Lengths are taken in decreasing order and each piece goes to the
   open sequence with the least room that holds it, found in logarithmic time
   with a segment tree over remaining capacities. Equal decisions in a row are
   one run.
3. A piece's number within its length, over all tasks, names its run, and the
   run gives its sequence and place. Only (task, length) counts are summed over
   tasks, so a length that a third of all documents share is no hot group.

Defined results: null text is an empty text (its end token alone); repeated
rows and null ids are packed as they come; an empty table gives no rows; other
columns are not read. Sequence ids have no meaning beyond being equal.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arspark.llm.common import Scratch, released
from arspark.llm.text import as_bytes, blocks
from arspark.llm.tokens import word_encoder

BLOCK = 1 << 20


class CapacityTree:
    """Segment tree over remaining capacities 0..most: how many open bins each has."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, n: int) -> None:
        k = room + self.leaves
        while k:
            self.count[k] += n
            k >>= 1

    def tightest(self, need: int) -> int | None:
        """The least room of at least ``need`` that an open bin has."""
        k = need + self.leaves
        if self.count[k]:
            return need
        while k > 1:  # up, until a right sibling has bins
            if not k & 1 and self.count[k + 1]:
                k += 1
                break
            k >>= 1
        if k == 1:
            return None
        while k < self.leaves:
            k = 2 * k if self.count[2 * k] else 2 * k + 1
        return k - self.leaves


def best_fit_runs(counts: dict[int, int], most: int) -> np.ndarray:
    """Best fit, lengths decreasing. Rows (length, first rank, first bin, pieces a bin, place).

    Piece number r of a length belongs to its run with the largest first rank
    up to r; with i = r - first rank it lies in bin first bin + i // pieces a
    bin, at place + (i % pieces a bin) * length.
    """
    tree, rooms, bins, runs = CapacityTree(most), {}, 0, []

    def opened(room: int, first: int, n: int) -> None:
        if n and room:
            rooms.setdefault(room, []).append((first, n))
            tree.add(room, n)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, n = most, bins, -(-left // (most // length))
                bins += n
            else:
                first, n = rooms[room].pop()
                tree.add(room, -n)
            each = room // length  # a bin that took one stays the tightest until it is full for this length
            used = min(n, -(-left // each))
            took = min(left, used * each)
            runs.append((length, rank, first, each, most - room))
            opened(room, first + used, n - used)
            full, rest = divmod(took, each)
            opened(room - each * length, first, full)
            if rest:
                opened(room - rest * length, first + full, 1)
            rank, left = rank + took, left - took
    return np.array(runs, dtype=np.int64).reshape(-1, 5)


def _pieces(tokenizer: str, most: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task, seen = word_encoder(tokenizer), TaskContext.get().partitionId(), np.zeros(most + 1, dtype=np.int64)
        for batch in batches:
            raw, off = as_bytes(batch.column(1))
            for i, j in blocks(off, BLOCK):
                ids, bound = enc.encode_block(raw[off[i]:off[j]], off[i:j + 1] - off[i])
                doc, piece, length, crc, out = [], [], [], [], []
                for k in range(j - i):
                    own = np.append(ids[bound[k]:bound[k + 1]], np.uint32(end_id)).astype("<u4")
                    for p, at in enumerate(range(0, len(own), most)):
                        part = own[at:at + most]
                        doc.append(i + k)
                        piece.append(p)
                        length.append(len(part))
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            out.append(part.astype(np.int32))
                n = np.array(length, dtype=np.int64)
                order = np.argsort(n, kind="stable")
                ranked = n[order]
                head = np.concatenate([[0], np.flatnonzero(np.diff(ranked)) + 1]) if len(n) else np.zeros(0, int)
                runs = np.diff(np.append(head, len(n)))
                local = np.empty(len(n), dtype=np.int64)
                local[order] = np.arange(len(n)) - np.repeat(head, runs) + seen[ranked]
                seen[ranked[head]] += runs
                cols = [batch.column(0).take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()), pa.array(np.array(piece, np.int64) * most),
                        pa.array(n), pa.array(np.array(crc, dtype=np.int64)), pa.array(np.full(len(n), task, np.int64)), pa.array(local)]
                names = ["id", "piece", "start", "length", "ids_crc32", "task", "local"]
                if with_ids:
                    cols.append(pa.array(out, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)
        enc.empty()
    return run


def _place(runs):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = runs.value
        order = np.lexsort((table[:, 1], table[:, 0]))
        length, first, start, each, place = table[order].T
        for batch in batches:
            n, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            lo, hi = np.searchsorted(length, n, "left"), np.searchsorted(length, n, "right")
            while True:  # binary search for the last run that starts at or before the rank
                wide = hi - lo > 1
                if not wide.any():
                    break
                mid = (lo + hi) // 2
                up = wide & (first[mid] <= rank)
                lo, hi = np.where(up, mid, lo), np.where(wide & ~up, mid, hi)
            i = rank - first[lo]
            cols = [batch.column(c) for c in batch.schema.names if c != "rank"]
            names = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(start[lo] + i // each[lo]), pa.array(place[lo] + i % each[lo] * n)],
                                             [*names, "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = 4096,
         end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    ``tokenizer``: a vocabulary file for ``tokens.WordEncoder`` that every executor can read.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType
    fields = [T.StructField("id", kind), T.StructField("piece", T.IntegerType())]
    fields += [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "task", "local")]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    scratch = Scratch(spark, "pack")
    pieces = scratch.save(rows.mapInArrow(released(_pieces(tokenizer, max_tokens, end_id, with_ids)), T.StructType(fields)), keep=True)
    per_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    # one row for each length and task
    before = per_task.select("length", "task", (F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")).alias("before"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most max_tokens rows
    runs = spark.sparkContext.broadcast(best_fit_runs(counts, max_tokens))
    ranked = pieces.join(before, ["length", "task"]).withColumn("rank", F.col("local") + F.col("before"))
    names = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    ranked = ranked.select(*names, "rank")
    schema = T.StructType([ranked.schema[c] for c in names] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(released(_place(runs)), schema).withColumnRenamed("id", id_col)


def sequences(packed: DataFrame, end: str = "ids") -> DataFrame:
    """The packed sequences themselves: (sequence_id, ids), from ``pack(..., with_ids=True)``.

    A group holds at most ``max_tokens`` tokens.
    """
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", end))).alias("p"))
    return parts.select("sequence_id", F.flatten(F.col(f"p.{end}")).alias("ids"))
