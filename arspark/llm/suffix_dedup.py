"""Removal of byte strings that repeat across a corpus, by merged sparse suffix arrays.

A byte goes if a ``length``-byte string that covers it also starts anywhere
else. Suffixes are sampled: of every ``length``-byte window, the suffix at its
anchor, the place of the least gram hash in it (the leftmost, if
tied). Equal windows have their anchors at equal places, so a window can only
repeat where its anchor's gram does, and suffixes are only compared with
suffixes of the same gram.

1. Tasks find anchors. Consecutive windows with one anchor are a stretch; its
   context is the bytes those windows cover. Anchors that occur once end here:
   most of them.
2. Contexts that occur twice or more (by hash) repeat as a whole.
3. What is left are contexts that differ from others of their gram: borders of
   repeats. Their bytes are fetched and go, by gram, to tasks that merge them:

   * The suffixes at the anchors, as they come from the shards, are interleaved
     by refinement: pass t looks at 8-byte symbol t of those suffixes only that
     are still in an interval with others, reorders inside the intervals, and
     splits them. The pass that splits two neighbours gives their common prefix.
   * Suffixes one byte further left follow from the order at hand as in a
     Burrows-Wheeler transform: a stable sort by the preceding byte, with the
     new common prefixes one more than the least between the two old places.
     No suffix is sorted again. After s such steps, neighbours with a common
     prefix of ``length`` or more are repeated windows that begin s bytes before
     their anchors.

4. Windows found are merged to spans by text, and joined to the texts again.

A gram with more than ``MOST`` different contexts isn't merged in one task: the
windows of its contexts are counted by hash, with partial aggregation.

Defined results: a null text is empty and, like any text shorter than
``length``, keeps everything; repeated rows repeat each other's strings; null
ids are results like others; an empty table gives no rows; other columns are
only read if carried. A cut can fall inside a character.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arspark.llm.common import Scratch, released, rows_with_ids
from arspark.llm.text import as_bytes, blocks, mix, odd

#: Bytes looked at together; a longer text goes in overlapping parts. Below 2**24, for positions.
BLOCK = 1 << 18
#: Contexts of one gram that one task merges, and rows merged at a time at least.
MOST, AT_ONCE = 100_000, 4096
_BASE = 0x5851F42D4C957F2D


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random value of each byte, and powers of the base and of its inverse."""
    table = np.random.default_rng(17).integers(0, 2**64, 256, dtype=np.uint64)
    out = []
    for b in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, b, dtype=np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return table, out[0], out[1]


class Hashes:
    """Polynomial hashes of all substrings of a buffer."""

    def __init__(self, buf: np.ndarray, room: int):
        table, power, self.inverse = _powers(room)
        self.prefix = np.zeros(len(buf) + 1, dtype=np.uint64)
        np.cumsum(table[buf] * power[:len(buf)], out=self.prefix[1:])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.prefix[b] - self.prefix[a]) * self.inverse[a]

    def runs(self, n: int) -> np.ndarray:
        """Hash of every substring of n bytes."""
        k = len(self.prefix) - n
        return mix((self.prefix[n:] - self.prefix[:k]) * self.inverse[:k])


def gram_size(length: int) -> int:
    """Bytes of a gram: long enough that few grams repeat by chance, short enough that a window has many. 128 for 400."""
    return max(1, length * 8 // 25)


def window_least(v: np.ndarray, w: int) -> np.ndarray:
    """Least of each w consecutive values, by running least values inside blocks of w."""
    n = len(v)
    wide = np.full(-(-n // w) * w, np.iinfo(v.dtype).max, dtype=v.dtype)
    wide[:n] = v
    grid = wide.reshape(-1, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])


def stretches(buf: np.ndarray, start: np.ndarray, end: np.ndarray, length: int, room: int):
    """Stretches of windows with one anchor, in each part [start, end) of the buffer.

    Returns gram hash, context hash, anchor minus first window, number of
    windows, part, and first window.
    """
    gram = gram_size(length)
    n_win = np.maximum(end - start - length + 1, 0)
    total = int(n_win.sum())
    if not total:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    h = Hashes(buf, room)
    g = h.runs(gram)
    low = np.uint64((1 << 24) - 1)
    least = window_least((g & ~low) | np.arange(len(g), dtype=np.uint64), length - gram + 1)
    part = np.repeat(np.arange(len(start)), n_win)
    p = np.arange(total) + np.repeat(start - (np.cumsum(n_win) - n_win), n_win)
    anchor = (least[p] & low).astype(np.int64)
    new = np.ones(total, dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])
    head = np.flatnonzero(new)
    wins = np.diff(np.append(head, total))
    first, anchor, part = p[head], anchor[head], part[head]
    left = anchor - first
    size = wins + length - 1
    ctx = mix(h.of(first, first + size) + size.astype(np.uint64) * odd(20) + left.astype(np.uint64) * odd(21))
    return g[anchor].view(np.int64), ctx.view(np.int64), left, wins, part, first


def _parts(off: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Buffer bounds and the parts in them: (begin, part starts, part ends, rows). Parts of a long row overlap by length - 1 bytes."""
    for i, j in blocks(off, BLOCK):
        if off[j] - off[i] <= BLOCK + length:
            yield int(off[i]), off[i:j], off[i + 1:j + 1], np.arange(i, j)
        else:
            for a in range(int(off[i]), int(off[j]) - length + 1, BLOCK):
                yield a, np.array([a]), np.array([min(a + BLOCK + length - 1, int(off[j]))]), np.array([i])


def _anchors(length: int):
    room = BLOCK + 2 * length
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = as_bytes(batch.column("text"))
            key = batch.column("key").to_numpy(zero_copy_only=False)
            for base, start, end, rows in _parts(off, length):
                gram, ctx, left, wins, part, first = stretches(raw[base:end[-1]], start - base, end - base, length, room)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram), pa.array(ctx), pa.array(left.astype(np.int32)), pa.array(wins.astype(np.int32)), pa.array(key[rows[part]] if len(part) else part),
                     pa.array(first + base - off[rows[part]] if len(part) else part)], ["gram", "ctx", "lead", "wins", "key", "at"])
    return run


def _contexts(length: int):
    """Bytes of the contexts asked for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, key, asked in zip(*(batch.column(c).to_pylist() for c in ("text", "key", "asked"))):
                raw = text.encode()
                cut = [raw[x["at"]:x["at"] + x["wins"] + length - 1] for x in asked]
                cols = [pa.array([x[c] for x in asked], t) for c, t in (("gram", pa.int64()), ("ctx", pa.int64()), ("lead", pa.int32()), ("wins", pa.int32()))]
                yield pa.RecordBatch.from_arrays([*cols, pa.array([key] * len(asked), pa.int64()), pa.array([x["at"] for x in asked], pa.int64()), pa.array(cut, pa.binary())],
                                                 ["gram", "ctx", "lead", "wins", "key", "at", "bytes"])
    return run


def interleave(group: np.ndarray, right: np.ndarray, avail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes, group by group, and the common prefix of each with the one before (-1: another group).

    ``right``: bytes from the anchor on, zero-padded to a multiple of 8;
    ``avail``: how many there are.
    """
    m = len(group)
    order = np.argsort(group, kind="stable")
    symbols = np.ascontiguousarray(right).view(">u8")
    common = np.full(m, -2, dtype=np.int64)  # -2: not split yet
    common[0] = -1
    common[1:][group[order][1:] != group[order][:-1]] = -1
    for t in range(symbols.shape[1]):
        split = common != -2
        interval = np.cumsum(split)
        joined = np.zeros(m, dtype=bool)  # places in an interval with others
        joined[1:] |= ~split[1:]
        joined[:-1] |= ~split[1:]
        at = np.flatnonzero(joined)
        if not len(at):
            break
        who, iv = order[at], interval[at]
        sym, more = symbols[who, t].astype(np.uint64), avail[who] > 8 * (t + 1)
        by = np.lexsort((more, sym, iv))
        who, sym, more = who[by], sym[by], more[by]
        order[at] = who
        same = iv[1:] == iv[:-1]
        differ = sym[1:] ^ sym[:-1]
        ends = same & ((differ != 0) | ~more[1:] | ~more[:-1])
        k = np.flatnonzero(ends)
        # leading equal bytes of the symbol
        lead = 7 - np.floor(np.log2(np.maximum(differ[k].astype(np.float64), 1)) / 8).astype(np.int64)
        exact = _leading(differ[k], lead)
        got = np.where(differ[k] != 0, 8 * t + exact, 8 * (t + 1))
        common[at[k + 1]] = np.minimum(got, np.minimum(avail[who[k]], avail[who[k + 1]]))
    rest = np.flatnonzero(common == -2)
    common[rest] = np.minimum(avail[order[rest]], avail[order[rest - 1]])
    return order, common


def _leading(differ: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """Number of leading zero bytes; the guess from a rounded logarithm may be one off."""
    out = np.clip(guess, 0, 7)
    for step in (-1, 1):
        other = np.clip(out + step, 0, 7)
        top = lambda b: (differ >> (np.uint64(56) - np.uint64(8) * b.astype(np.uint64))) != 0  # noqa: E731  a set bit in bytes 0..b
        out = np.where((step < 0) & (other < out) & top(other), other, np.where((step > 0) & ~top(out), other, out))
    return out


def least_between(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least of values[a:b], for a < b, by a table of powers of two."""
    size = b - a
    level = np.frexp(size.astype(np.float64))[1] - 1
    out = np.empty(len(a), dtype=values.dtype)
    table, k = values, 0
    while True:
        at = np.flatnonzero(level == k)
        if len(at):
            out[at] = np.minimum(table[a[at]], table[b[at] - (1 << k)])
        if not (level > k).any():
            return out
        table = np.minimum(table[:-(1 << k)], table[1 << k:])
        k += 1


def repeated(group: np.ndarray, lead: np.ndarray, wins: np.ndarray, before: np.ndarray, right: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, s) of windows that begin s bytes before row's anchor and equal a window of another row of its group.

    ``before``: bytes before the anchor, nearest first.
    """
    avail = length - (lead - wins + 1)  # bytes from the anchor on
    order, common = interleave(group, right, avail)
    rows, steps = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for s in range(int(lead.max()) + 1):
        nearest = common.copy()
        nearest[:-1] = np.maximum(nearest[:-1], common[1:])
        hit = order[nearest >= length]
        rows.append(hit)
        steps.append(np.full(len(hit), s))
        # out goes what has no byte to the left in its stretch, and what can't reach the length any more
        keep = np.flatnonzero((lead[order] > s) & (nearest + lead[order] - s >= length))
        if len(keep) < 2:
            break
        who = order[keep]
        key = group[who] * 256 + before[who, s]
        by = np.argsort(key, kind="stable")
        old, key = keep[by], key[by]
        same = np.flatnonzero(key[1:] == key[:-1])
        after = np.full(len(old), -1, dtype=np.int64)
        after[same + 1] = 1 + least_between(common, old[same] + 1, old[same + 1] + 1)
        order, common = order[old], after
    return np.concatenate(rows), np.concatenate(steps)


def _merge(length: int):
    """Rows come sorted by gram."""
    wide = -(-length // 8) * 8

    def solve(rows: list) -> pa.RecordBatch:
        unique = list({(r[0], r[1]): r for r in rows}.values())  # a text that several rows hold is fetched once or more
        gram, _, lead, wins, key, at, data = zip(*unique)
        group = np.unique(np.array(gram), return_inverse=True)[1].astype(np.int64)
        lead, wins, key, at = (np.array(x, dtype=np.int64) for x in (lead, wins, key, at))
        before = np.zeros((len(unique), int(lead.max()) + 1), dtype=np.uint8)
        right = np.zeros((len(unique), wide), dtype=np.uint8)
        for k, (n, b) in enumerate(zip(lead.tolist(), data)):
            x = np.frombuffer(b, dtype=np.uint8)
            before[k, :n] = x[:n][::-1]
            right[k, :len(x) - n] = x[n:]
        row, s = repeated(group, lead, wins, before, right, length)
        by = np.lexsort((-s, row))
        row, p = row[by], (at[row] + lead[row] - s)[by]
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (p[1:] != p[:-1] + 1)
        head = np.flatnonzero(new)
        last = np.append(head[1:], len(row)) - 1 if len(head) else head
        return pa.RecordBatch.from_arrays([pa.array(key[row[head]]), pa.array(p[head]), pa.array(p[last] + length)], ["key", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("gram", "ctx", "lead", "wins", "key", "at", "bytes"))):
                if len(held) >= AT_ONCE and held[-1][0] != r[0]:
                    yield solve(held)
                    held = []
                held.append(r)
        if held:
            yield solve(held)
    return run


def _windows(length: int):
    """Every window of the contexts of very frequent grams, by hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gram, wins, key, at, data in zip(*(batch.column(c).to_pylist() for c in ("gram", "wins", "key", "at", "bytes"))):
                x = np.frombuffer(data, dtype=np.uint8)
                h = Hashes(x, BLOCK + 2 * length).runs(length).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(wins, gram)), pa.array(h), pa.array(np.full(wins, key)), pa.array(at + np.arange(wins))], ["gram", "h", "key", "a"])
    return run


def repeated_spans(texts: DataFrame, scratch: Scratch, length: int = 400, most: int = MOST) -> DataFrame:
    """(key, spans) of texts with repeated strings; ``texts`` has columns key (a hash of the text) and text."""
    long_enough = texts.filter(F.octet_length("text") >= length)
    found = scratch.save(long_enough.mapInArrow(released(_anchors(length)), "gram long, ctx long, lead int, wins int, key long, at long"))
    # a table of its own, so that the join can split a gram with very many stretches
    twice = scratch.save(found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram"))
    shared = scratch.save(found.join(twice, "gram", "left_semi"))
    scratch.drop(found, twice)
    by_ctx = scratch.save(shared.groupBy("gram", "ctx").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "at", "lead", "wins")).alias("m")))
    whole = shared.join(by_ctx.filter("n > 1").select("gram", "ctx"), ["gram", "ctx"]).select("key", F.col("at").alias("a"), (F.col("at") + F.col("wins") + (length - 1)).alias("b"))
    # contexts of grams that have several, one of them not repeated as a whole
    mixed = by_ctx.groupBy("gram").agg(F.count(F.lit(1)).alias("n_ctx"), F.min("n").alias("least")).filter("n_ctx > 1 AND least = 1")
    asked = by_ctx.join(mixed, "gram").select("m.key", F.struct("gram", "ctx", "m.at", "m.lead", "m.wins").alias("x"))
    asked = scratch.save(asked.groupBy("key").agg(F.collect_list("x").alias("asked")))  # as many as a text has stretches at most
    rows = rows_with_ids(long_enough, asked.select("key"), "key").groupBy("key").agg(F.first("text").alias("text")).join(asked, "key")
    contexts = rows.mapInArrow(released(_contexts(length)), "gram long, ctx long, lead int, wins int, key long, at long, bytes binary")
    heavy = mixed.filter(F.col("n_ctx") > most).select("gram")
    if heavy.isEmpty():
        merged = contexts.repartition("gram").sortWithinPartitions("gram").mapInArrow(released(_merge(length)), "key long, a long, b long")
    else:
        contexts = scratch.save(contexts)
        light = contexts.join(heavy, "gram", "left_anti").repartition("gram").sortWithinPartitions("gram")
        merged = light.mapInArrow(released(_merge(length)), "key long, a long, b long")
        windows = contexts.join(heavy, "gram", "left_semi").dropDuplicates(["gram", "ctx"]).mapInArrow(released(_windows(length)), "gram long, h long, key long, a long")
        again = windows.groupBy("gram", "h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram", "h")
        merged = merged.union(windows.join(again, ["gram", "h"], "left_semi").select("key", "a", (F.col("a") + length).alias("b")))
    spans = whole.union(merged).distinct()
    return spans.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans"))


def _cut(keep: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = as_bytes(batch.column("text"))
            data = raw.tobytes()
            out: list[list] = [[] for _ in range(5)]
            for k, spans in enumerate(batch.column("spans").to_pylist()):
                text, merged = data[off[k]:off[k + 1]], []
                for x in spans or ():
                    if merged and x["a"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], x["b"])
                    else:
                        merged.append([x["a"], x["b"]])
                edge = [0, *(e for m in merged for e in m), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edge[::2], edge[1::2]))
                for c, v in zip(out, (len(text), len(text) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(),
                                      kept.decode("utf-8", "ignore") if keep == "text" else kept)):
                    c.append(v)
            names = [c for c in batch.schema.names if c not in ("text", "spans", "key")]
            cols = [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string() if keep == "text" else pa.binary()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *cols[:4 + bool(keep)]],
                                             [*names, "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * bool(keep)])
    return run


def remove_repeats(docs: DataFrame, text_col: str = "text", length: int = 400, carry: tuple[str, ...] = ("doc_id",), keep: str | None = None,
                   most: int = MOST) -> DataFrame:
    """Columns ``carry`` of every row, with n_bytes, n_removed, n_spans, kept_sha256.

    ``keep``: ``"bytes"`` adds the kept bytes; ``"text"`` adds them as text, without the bytes of characters that a cut splits.
    """
    names = {f"__c{k}": c for k, c in enumerate(carry)}
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(*(F.col(c).alias(k) for k, c in names.items()), text.alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    with Scratch(docs.sparkSession, "repeats") as scratch:
        spans = scratch.save(repeated_spans(rows.select("key", "text"), scratch, length, most), keep=True)
    # only texts that may have spans are joined; the bitmap has a fixed size
    maybe = rows_with_ids(rows, spans.select("key"), "key").join(spans, "key", "left").select(*rows.columns, "spans")
    none = rows_with_ids(rows, spans.select("key"), "key", others=True)  # these stay in the JVM
    schema = T.StructType([rows.schema[k] for k in names]
                          + T.StructType.fromDDL("n_bytes long, n_removed long, n_spans long, kept_sha256 string" + {None: "", "bytes": ", kept binary", "text": ", kept string"}[keep]).fields)
    whole = {"n_bytes": F.octet_length("text").cast("long"), "n_removed": F.lit(0).cast("long"), "n_spans": F.lit(0).cast("long"),
             "kept_sha256": F.sha2(F.col("text").cast("binary"), 256), "kept": F.col("text").cast("binary") if keep == "bytes" else F.col("text")}
    untouched = none.select(*(F.col(f.name) if f.name in names else whole[f.name].alias(f.name) for f in schema.fields))
    out = maybe.mapInArrow(released(_cut(keep)), schema).union(untouched)
    return out.select(*(F.col(k).alias(c) for k, c in names.items()), *(F.col(f.name) for f in schema.fields[len(names):]))
