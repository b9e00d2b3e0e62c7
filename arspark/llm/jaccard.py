"""Near-duplicate documents: an n-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct n-word shingles; two documents link when
``100 * |intersection| >= percent * |union|``. Equal sets are one class,
represented by one row, so copies are never paired with each other.

* Order. One pass counts all shingles of all documents in a fixed-size sketch
  (hashed counters). Shingles whose counter stands out are frequent; the order
  of shingles is: those that don't stand out by hash, then the frequent ones,
  rarest first. Any order gives right results; this one keeps common passages
  out of prefixes.
* Adaptive prefixes. With need = ceil(percent * n / 100), two linked documents
  share at least l shingles among their first n - need + l, for every l. A
  document's l starts at 1 and grows with the estimated number of candidates
  its prefix would bring: the prefix gets longer, and a partner must share
  correspondingly more of it. Two documents with different l are judged by the
  smaller one: each prefix entry knows its place in the order.
* Entries. Prefix entries go to ranges of the shingle hash, where shingles of
  one class only (most of them) end. Entries of very frequent shingles can't be
  alone; they are spread by document instead.
* Links. What is asked for is which documents are connected, so pairs within a
  connected group needn't all be seen. First each shingle's classes are paired
  with one of them (a star, as many pairs as entries; the centre is the class
  with most shared entries, which among altered copies is the original), pairs
  are verified on whole sets, and groups are joined. Then pairs of classes of
  different groups that share enough prefix entries are verified, so nothing is
  left out. For a pair the prefixes are those that its two sizes ask for, which
  are parts of the ones at hand.
* Stars. Altered copies of one text that don't link with it share most of their
  entries all the same, so pairing them by entries would form all pairs. Two
  classes a and b that tried the same centre h share at least
  k = (overlap that links them) - min(|a & h|, |b & h|) shingles outside h. Where
  k > 0 they meet by the shingles that they have beyond h, a prefix filter over
  those alone (the e - k + 1 first of e), and never by h's own. k is at most 0
  only if the shorter one lies almost whole in a longer h; those pairs, and pairs
  of different stars, meet by prefix entries. Stars with up to ``STAR`` classes
  that don't link with the centre are paired by entries as well, which is as exact.
* Counting bounds the overlap before any text is fetched: beyond their c shared
  prefix entries two documents share at most as much as the longer rest holds,
  so c must make up for what the threshold asks for their two sizes.
* Verification brings whole texts of candidates only (found by a bitmap of
  fixed size and an exact join) and streams each set past the set it is paired
  with; a class with many partners is spread over several tasks.

Defined results: null and empty texts have no shingles and link with nothing; a
text of fewer words has its whole sequence as one shingle; repeated rows are
copies; a null id never names a component unless all ids of it are null, but
texts of rows without an id link as all others do (texts are fetched by a key of
id and text, not by id); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arspark.llm.common import Scratch, released, rows_with_ids, trim
from arspark.llm.components import components
from arspark.llm.text import NOT_SPACE, Words, as_bytes, blocks, mix, odd, shingle_sets

#: Counters of the sketch, and how many are sent in one row.
SKETCH_BITS, CHUNK_BITS = 22, 14
#: A prefix's l grows by one each time its estimated candidates double beyond this, up to MOST_L,
#: as long as the shingles added bring no more than this each.
COST_UNIT, MOST_L = 64.0, 8
#: Shingles of an estimated frequency beyond this are spread by document.
SPREAD = 1 << 15
#: Entries of a task that are sent at once, and partners of a class that one task verifies.
FLUSH, PARTNERS = 1 << 18, 512
#: Classes that tried one centre without a link, beyond which the star is paired by what its classes have beyond the centre.
#: Up to this many, the pairs of a class cost less than reading the whole sets of its star twice more.
STAR = 128
#: Times that such a star's classes are held against a centre; after the first, against a better one.
TURNS = 2


def digests(vals: np.ndarray, first: np.ndarray) -> np.ndarray:
    """64-bit hash of each row's set, 0 for an empty one."""
    n = np.diff(first)
    total = np.zeros(len(n), dtype=np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        total[some] = mix(np.add.reduceat(mix(vals * odd(9)), first[:-1][some]) + n[some].astype(np.uint64) * odd(10))
    return total.view(np.int64)


def _sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    raw, off = as_bytes(batch.column("text"))
    for i, j in blocks(off):
        yield i, j, *shingle_sets(Words(raw, off, i, j, NOT_SPACE), words)


def _profile(words: int):
    """Rows of documents (key, class, n), and the sketch of a task's distinct sets in chunks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, seen = np.zeros(1 << SKETCH_BITS, dtype=np.int32), set()
        names = ["id", "key", "cls", "n", "chunk", "counts"]
        kind = None
        for batch in batches:
            kind = batch.schema.field("id").type
            for i, j, vals, first in _sets(batch, words):
                cls, n = digests(vals, first), np.diff(first)
                new = np.zeros(j - i, dtype=bool)
                for k, c in enumerate(cls.tolist()):
                    if c not in seen:
                        seen.add(c)
                        new[k] = True
                at, seen_at = np.unique((vals[np.repeat(new, n)] >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), return_counts=True)
                sketch[at] += seen_at.astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(i, j - i), batch.column("key").slice(i, j - i), pa.array(cls), pa.array(n), pa.nulls(j - i, pa.int32()), pa.nulls(j - i, pa.binary())], names)
        if kind is not None:
            parts = sketch.reshape(-1, 1 << CHUNK_BITS)
            some = np.flatnonzero(parts.any(axis=1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(some), kind), *(pa.nulls(len(some), pa.int64()) for _ in range(3)), pa.array(some),
                                              pa.array([zlib.compress(parts[k].tobytes(), 1) for k in some], pa.binary())], names)
    return run


def _sum_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, c in zip(batch.column("chunk").to_pylist(), batch.column("counts")):
            got = np.frombuffer(zlib.decompress(c.as_py()), dtype=np.int32)
            total[k] = total[k] + got if k in total else got.astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([zlib.compress(c.tobytes(), 1) for c in total.values()], pa.binary())], ["chunk", "counts"])


def levels_of(counts: np.ndarray, mean: float | None = None) -> np.ndarray:
    """For each counter 0, or 1 + floor(2 * log2(excess)) if it stands out from the mean load (of all counters, if these are some of them)."""
    mean = counts.mean() if mean is None else mean
    excess = counts - mean
    out = np.zeros(len(counts), dtype=np.uint8)
    high = excess > 5 * np.sqrt(mean) + 8
    out[high] = (1 + np.floor(2 * np.log2(excess[high]))).astype(np.uint8)
    return out


def _levels(vals: np.ndarray, level: np.ndarray) -> np.ndarray:
    return level[(vals >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.int64)


def prefixes(vals: np.ndarray, first: np.ndarray, level: np.ndarray, percent: int) -> tuple[np.ndarray, ...]:
    """Prefix entries of each row's set: (shingle, row, place in the row's order, the row's l, estimated frequency)."""
    n = np.diff(first)
    rows = np.repeat(np.arange(len(n)), n)
    lv = _levels(vals, level)
    order = np.argsort(rows * 256 + lv, kind="stable")
    vals, lv = vals[order], lv[order]
    at = np.arange(len(vals)) - np.repeat(first[:-1], n)
    need = -(-n * percent // 100)
    spare = n - need
    estimate = np.where(lv > 0, 2.0 ** ((lv - 1) / 2), 1.0)
    cost = np.bincount(rows, weights=np.where(at <= spare[rows], estimate, 0.0), minlength=len(n))
    # shingles that may be added: those after the shortest prefix that aren't frequent themselves
    cheap = np.bincount(rows, weights=(at > spare[rows]) & (estimate <= COST_UNIT), minlength=len(n)).astype(np.int64)
    most = np.minimum(MOST_L, np.minimum(np.maximum(need, 1), 1 + cheap))
    own = np.minimum(most, 1 + np.floor(np.log2(1 + cost / COST_UNIT)).astype(np.int64))
    take = at < (spare + own)[rows]
    return vals[take], rows[take], at[take], own[rows[take]], estimate[take]


def _entries(words: int, percent: int, sent, ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen, held, size = sent.value, set(), [], 0

        def flush() -> pa.RecordBatch:
            v, c, e, spread = (np.concatenate(x) for x in zip(*held))
            place = ((v >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)
            place[spread] = ranges + (c[spread] % ranges)
            order = np.argsort(place, kind="stable")
            v, c, e, place = v[order], c[order], e[order], place[order]
            head = np.flatnonzero(np.diff(place, prepend=-1))
            parts = list(zip(head.tolist(), np.append(head[1:], len(place)).tolist()))
            cut = lambda x: pa.array([x[a:b].tobytes() for a, b in parts], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(place[head]), cut(v), cut(c), cut(e)], ["place", "shingles", "classes", "places"])

        for batch in batches:
            for _, _, vals, first in _sets(batch, words):
                cls = digests(vals, first)
                new = np.zeros(len(cls), dtype=bool)
                for k, c in enumerate(cls.tolist()):
                    if c not in seen:
                        seen.add(c)
                        new[k] = True
                v, row, pos, own, estimate = prefixes(vals, first, level, percent)
                some = new[row]
                held.append((v[some], cls[row[some]], (pos[some] * 16 + own[some]).astype(np.uint32), estimate[some] > SPREAD))
                size += int(some.sum())
                if size > FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()
    return run


def _shared(ranges: int):
    """Entries of shingles that more than one class has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for p, *x in zip(*(batch.column(c).to_pylist() for c in ("place", "shingles", "classes", "places"))):
                held.setdefault(p, []).append(x)
        for p in sorted(held):
            parts = held.pop(p)
            v, c, e = (np.concatenate([np.frombuffer(x[k], dtype=t) for x in parts]) for k, t in enumerate((np.int64, np.int64, np.uint32)))
            order = np.lexsort((c, v))
            v, c, e = v[order], c[order], e[order]
            new = np.ones(len(v), dtype=bool)
            new[1:] = (v[1:] != v[:-1]) | (c[1:] != c[:-1])
            v, c, e = v[new], c[new], e[new]
            if p < ranges and len(v):
                same = v[1:] == v[:-1]
                more = np.append(same, False) | np.insert(same, 0, False)
                v, c, e = v[more], c[more], e[more]
            yield pa.RecordBatch.from_arrays([pa.array(v), pa.array(c), pa.array((e // 16).astype(np.int32)), pa.array((e % 16).astype(np.int32))], ["shingle", "cls", "pos", "own"])
    return run


def _whole_sets(words: int):
    """The set of each candidate's text, once for each use of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = as_bytes(batch.column("text"))
            use, cls = batch.column("use"), batch.column("cls").to_numpy(zero_copy_only=False)
            for i, j in blocks(off):
                vals, first = shingle_sets(Words(raw, off, i, j, NOT_SPACE), words)
                own = digests(vals, first) == cls[i:j]  # another text may have the same key
                at = np.flatnonzero(own)
                blobs = pa.array([vals[first[k]:first[k + 1]].tobytes() for k in at.tolist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*use.slice(i, j - i).take(pa.array(at)).flatten(), pa.array(cls[i:j][at]), blobs], ["hub", "part", "member", "cls", "vals"])
    return run


def _verify(percent: int):
    """Rows come sorted by (hub, part, member): the hub's own set, then its partners'."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, None
        for batch in batches:
            a, b = [], []
            for hub, member, cls, vals in zip(*(batch.column(c).to_pylist() for c in ("hub", "member", "cls", "vals"))):
                x = np.frombuffer(vals, dtype=np.uint64)
                if not member:
                    now, own = hub, x
                    continue
                if now != hub or 100 * min(len(x), len(own)) < percent * max(len(x), len(own)):
                    continue
                k = np.searchsorted(own, x)
                both = int((own[np.minimum(k, len(own) - 1)] == x).sum())
                if 100 * both >= percent * (len(x) + len(own) - both):
                    a.append(hub)
                    b.append(cls)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def _beyond(percent: int, sent):
    """Rows come sorted as for ``_verify``. For each partner one row with its overlap with the hub (pos -1), and its first shingles beyond the hub."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, now, own = sent.value, None, None
        for batch in batches:
            head, found = [], []
            for hub, member, cls, vals in zip(*(batch.column(c).to_pylist() for c in ("hub", "member", "cls", "vals"))):
                x = np.frombuffer(vals, dtype=np.uint64)
                if not member:
                    now, own = hub, x
                    continue
                if now != hub:
                    continue
                k = np.searchsorted(own, x)
                rest = x[own[np.minimum(k, len(own) - 1)] != x]
                both = len(x) - len(rest)
                first = rest[np.argsort(_levels(rest, level), kind="stable")]
                first = first[:max(0, len(rest) - max(1, -(-len(x) * percent // 100) - both) + 1)]
                head.append((hub, cls, both, len(own), 1 + len(first)))
                found.append(np.concatenate([np.zeros(1, np.uint64), first]).view(np.int64))
            if head:
                hub, cls, both, size, times = (np.array(c, dtype=np.int64) for c in zip(*head))
                pos = np.concatenate([np.arange(-1, t - 1) for t in times.tolist()]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*(pa.array(np.repeat(c, times)) for c in (hub, cls, both, size)), pa.array(np.concatenate(found)), pa.array(pos)],
                                                 ["star", "cls", "both", "n_star", "shingle", "pos"])
    return run


def _verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, words: int, percent: int, scratch: Scratch) -> DataFrame:
    """Of pairs of classes, those that link, as (a, b). Columns hub, own_hub, cls, own, and shared: prefix entries in common."""
    size = lambda c: classes.select(F.col("cls").alias(c), F.col("n").alias(f"n_{c}"))
    near = pairs.join(size("hub"), "hub").join(size("cls"), "cls")
    rest = lambda n, own: F.ceil(F.col(n) * percent / 100) - F.col(own)  # noqa: E731  elements after the prefix
    least = F.ceil((F.col("n_hub") + F.col("n_cls")) * percent / (100 + percent))  # overlap that links them
    near = near.filter((F.least("n_hub", "n_cls") * 100 >= F.greatest("n_hub", "n_cls") * percent)
                       & (F.col("shared") >= least - F.greatest(rest("n_hub", "own_hub"), rest("n_cls", "own"))))
    near = scratch.save(near.select("hub", "cls"))
    edges = scratch.save(_by_hub(near, classes, texts, words, scratch).mapInArrow(released(_verify(percent)), "a long, b long").distinct())
    scratch.drop(near)
    return edges


def _by_hub(near: DataFrame, classes: DataFrame, texts: DataFrame, words: int, scratch: Scratch) -> DataFrame:
    """Whole sets of the pairs (hub, cls), sorted within tasks: a hub's own set, then its partners'."""
    parts = near.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).cast("int").alias("parts"))
    # partners of a hub with many of them are dealt over several parts, each of which gets the hub's own set
    member = near.join(parts, "hub").select("hub", F.pmod(F.hash("cls"), F.col("parts")).alias("part"), F.lit(1).alias("member"), "cls")
    own = parts.select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("member"), F.col("hub").alias("cls"))
    uses = member.union(own).join(classes.select("cls", F.col("first").alias("key")), "cls")
    uses = scratch.save(uses.select("key", "cls", F.struct("hub", "part", "member").alias("use")))
    # repeated rows have the same key; one of them will do
    rows = rows_with_ids(texts, uses.select("key").distinct(), "key").select("key", "text").dropDuplicates(["key"]).join(uses, "key").select("use", "cls", "text")
    sets = rows.mapInArrow(released(_whole_sets(words)), "hub long, part int, member int, cls long, vals binary")
    return sets.repartition("hub", "part").sortWithinPartitions("hub", "part", "member")


def _level(profile: DataFrame) -> np.ndarray:
    """Level of each counter of the sketch that all tasks' chunks add up to. The driver holds the chunks packed and unpacks one at a time."""
    # as many rows as the sketch has chunks
    chunks = profile.filter("chunk IS NOT NULL").select("chunk", "counts").repartition("chunk").mapInArrow(released(_sum_chunks), "chunk int, counts binary").collect()
    counts = lambda r: np.frombuffer(zlib.decompress(r["counts"]), dtype=np.int64)
    mean = sum(int(counts(r).sum()) for r in chunks) / (1 << SKETCH_BITS)
    level = np.zeros((1 << (SKETCH_BITS - CHUNK_BITS), 1 << CHUNK_BITS), dtype=np.uint8)
    for r in chunks:
        level[r["chunk"]] = levels_of(counts(r), mean)
    return level.ravel()


def classes_of(docs: DataFrame, scratch: Scratch, words: int = 5, percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """(id, cls, n) of every row of ``docs`` (columns id, text), and (cls, root) of classes that link with another."""
    spark = docs.sparkSession
    kind = docs.schema["id"].dataType
    docs = docs.withColumn("key", F.xxhash64("id", "text"))
    found = T.StructType([T.StructField("id", kind), *T.StructType.fromDDL("key long, cls long, n long, chunk int, counts binary").fields])
    profile = scratch.save(docs.mapInArrow(released(_profile(words)), found))
    level = spark.sparkContext.broadcast(_level(profile))
    trim()
    rows = profile.filter("chunk IS NULL")
    members = rows.select("id", "cls", "n")
    # the row that stands for a class: that of its smallest id, or one without an id if it has no other
    first = F.coalesce(F.min_by("key", "id"), F.min("key"))
    classes = scratch.save(rows.filter("n > 0").groupBy("cls").agg(first.alias("first"), F.min("n").alias("n")))

    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    entries = docs.mapInArrow(released(_entries(words, percent, level, ranges)), "place int, shingles binary, classes binary, places binary")
    shared = entries.repartition("place").mapInArrow(released(_shared(ranges)), "shingle long, cls long, pos int, own int")
    shared = scratch.save(shared)

    # with each class's size, and how many of its entries others have: an original has more than its altered copies
    of_class = shared.groupBy("cls").agg(F.count(F.lit(1)).alias("degree")).join(classes.select("cls", "n"), "cls")
    wide = scratch.save(shared.join(of_class, "cls"))
    scratch.drop(shared)
    # a star for each shingle; each class tries the centre it shares most with
    centre = wide.groupBy("shingle").agg(F.max(F.struct("degree", "cls", "own")).alias("c"))
    pairs = wide.join(centre, "shingle").filter("cls != c.cls").select(F.col("c.cls").alias("hub"), F.col("c.own").alias("own_hub"), "cls", "own")
    pairs = pairs.groupBy("hub", "cls").agg(F.count(F.lit(1)).alias("shared"), F.first("own_hub").alias("own_hub"), F.first("own").alias("own"))
    pairs = pairs.groupBy("cls").agg(F.max(F.struct("shared", "hub", "own_hub", "own")).alias("p")).select("cls", "p.*")
    tried = scratch.save(pairs)
    edges = _verified(tried, classes, docs, words, percent, scratch)
    roots = components(edges, scratch)
    # every pair of different groups that shares enough of its prefixes
    crowd = _crowded(tried, classes, roots, scratch)
    left = scratch.save(_mixed(wide, roots, crowd))
    if crowd.isEmpty():
        pairs = _enough(_shared_places(left, left, ("shingle",), percent))
    else:
        for turn in range(TURNS):
            beyond = scratch.save(_by_hub(crowd.select(F.col("star").alias("hub"), "cls"), classes, docs, words, scratch).mapInArrow(
                released(_beyond(percent, level)), "star long, cls long, both long, n_star long, shingle long, pos int"))
            overlap = scratch.save(beyond.filter("pos < 0").drop("shingle", "pos").distinct())
            known = overlap.filter("star != cls").join(classes.select("cls", "n"), "cls")
            linked = F.col("both") * 100 >= percent * (F.col("n") + F.col("n_star") - F.col("both"))
            edges = scratch.save(edges.union(known.filter(linked).select(F.col("star").alias("a"), F.col("cls").alias("b"))))
            if turn + 1 < TURNS:
                crowd = scratch.save(crowd.drop("star").join(_recentred(beyond, overlap, crowd), "cls"))
        roots = components(edges, scratch)
        groups = scratch.save(roots.select(F.col("node").alias("cls"), "root"))
        crowd = scratch.save(crowd.join(groups, "cls", "left").withColumn("grp", F.coalesce("root", "cls")).drop("root"))
        stars = overlap.join(crowd.select("cls", "grp"), "cls")
        pairs = _apart_or_inside(left, stars, percent, scratch).union(_outside(beyond.filter("pos >= 0"), crowd, percent)).distinct()
        # entries of other classes still have the groups from before the stars
        side = lambda k: groups.select(F.col("cls").alias(f"cls_{k}"), F.col("root").alias(f"root_{k}"))
        pairs = pairs.join(side("a"), "cls_a", "left").join(side("b"), "cls_b", "left").filter(F.coalesce("root_a", "cls_a") != F.coalesce("root_b", "cls_b"))
    pairs = pairs.select(F.col("cls_a").alias("hub"), F.col("cls_b").alias("cls"), F.col("own_a").alias("own_hub"), F.col("own_b").alias("own"))
    edges = edges.union(_verified(_counted(pairs, left), classes, docs, words, percent, scratch))
    roots = components(edges, scratch)
    return members, roots.select(F.col("node").alias("cls"), "root")


def _sides(a: DataFrame, b: DataFrame, keys: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Both tables with their columns named by side, but for ``keys``."""
    return tuple(x.select(*(F.col(c).alias(c if c in keys else f"{c}_{k}") for c in x.columns)) for x, k in ((a, "a"), (b, "b")))


def _ordered(percent: int) -> Column:
    """The pair is of different groups, a is the shorter one, and the sizes can link."""
    return (F.col("grp_a") != F.col("grp_b")) & (F.struct("n_a", "cls_a") < F.struct("n_b", "cls_b")) & (F.col("n_a") * 100 >= F.col("n_b") * percent)


def _least(percent: int) -> Column:
    """Overlap that links a pair."""
    return F.ceil((F.col("n_a") + F.col("n_b")) * percent / (100 + percent))


def _shared_places(a: DataFrame, b: DataFrame, keys: tuple[str, ...], percent: int) -> DataFrame:
    """Prefix entries, as (cls_a, cls_b, own_a, own_b, ...), that pairs share inside the prefixes that their sizes ask for."""
    a, b = _sides(a, b, keys)
    a = a.filter(F.col("pos_a") < F.col("n_a") - F.ceil(2 * F.col("n_a") * percent / (100 + percent)) + F.col("own_a"))  # a is the shorter one
    match, least = F.least("own_a", "own_b"), _least(percent)
    # the l-prefixes that this pair's sizes ask for; they are parts of both prefixes
    inside = (F.col("pos_a") < F.col("n_a") - least + match) & (F.col("pos_b") < F.col("n_b") - least + match)
    return a.join(b, list(keys)).filter(_ordered(percent) & inside)


def _enough(shared: DataFrame) -> DataFrame:
    """Pairs that share as many prefix entries as both prefixes ask for."""
    pairs = shared.groupBy("cls_a", "cls_b").agg(F.count(F.lit(1)).alias("shared"), F.first("own_a").alias("own_a"), F.first("own_b").alias("own_b"))
    return pairs.filter(F.col("shared") >= F.least("own_a", "own_b")).drop("shared")


def _crowded(tried: DataFrame, classes: DataFrame, roots: DataFrame, scratch: Scratch) -> DataFrame:
    """(star, cls, n, own) of the classes whose centre more than ``STAR`` classes tried without a link."""
    side = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    stars = scratch.save(tried.select("cls", "own", F.col("hub").alias("star")).join(side("cls"), "cls", "left").join(side("star"), "star", "left"))
    lone = stars.filter(F.coalesce("root_cls", "cls") != F.coalesce("root_star", "star"))
    crowds = lone.groupBy("star").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > STAR).select("star")
    return scratch.save(stars.select("star", "cls", "own").join(crowds, "star").join(classes.select("cls", "n"), "cls"))


def _recentred(beyond: DataFrame, overlap: DataFrame, crowd: DataFrame) -> DataFrame:
    """(cls, star): each star's classes with its better centre, the class that has most of what is common in the star.

    That is what the old centre has, and the shingles beyond it that more than half of the classes have.
    """
    size = overlap.groupBy("star").agg(F.count(F.lit(1)).alias("k"))
    common = beyond.filter("pos >= 0").groupBy("star", "shingle").agg(F.count(F.lit(1)).alias("m")).join(size, "star").filter("2 * m > k").select("star", "shingle")
    more = beyond.filter("pos >= 0").join(common, ["star", "shingle"]).groupBy("cls").agg(F.count(F.lit(1)).alias("more"))
    near = overlap.join(more, "cls", "left").withColumn("near", F.col("both") + F.coalesce("more", F.lit(0)))
    best = near.groupBy("star").agg(F.max_by("cls", F.struct("near", "cls")).alias("centre"))
    return crowd.select("cls", "star").join(best, "star").select("cls", F.col("centre").alias("star"))


def _apart_or_inside(left: DataFrame, stars: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs by prefix entries, but for those of one star that must share a shingle beyond its centre. ``stars``: star, cls, both, n_star, grp."""
    # most entries are of no star and meet none: they bring along what tells them, so nothing is looked up for each
    entries = lambda which: left.filter(which).select("shingle", "cls", "grp", "n", "own", "pos")
    inner = scratch.save(entries("crowded").drop("grp").join(stars, "cls"))
    outer, near = entries("NOT crowded"), entries("NOT crowded AND meets")
    names = ("cls_a", "cls_b", "own_a", "own_b")
    found = _shared_places(outer, outer, ("shingle",), percent).select(*names)
    # a star's classes have all been held against its centre
    one = _shared_places(near, inner, ("shingle",), percent).filter("star_b != cls_a").select(*names)
    other = _shared_places(inner, near, ("shingle",), percent).filter("star_a != cls_b").select(*names)
    found = found.union(one).union(other)
    # two stars: shingles that both have, so that classes of one star never meet here
    has = scratch.save(inner.select("shingle", "star").distinct())
    both = has.withColumnRenamed("star", "star_a").join(has.withColumnRenamed("star", "star_b"), "shingle").filter("star_a != star_b")
    between = both.withColumnRenamed("star_a", "star").join(inner, ["shingle", "star"]).withColumnRenamed("star", "centre")
    between = _shared_places(between.withColumnRenamed("star_b", "star"), inner, ("shingle", "star"), percent)
    found = found.union(between.filter("centre_a != cls_b AND star != cls_a").select(*names))
    # one star: the shorter class lies almost whole in the centre, which is longer
    short = inner.filter((F.col("n") < F.col("n_star")) & (F.col("both") >= F.ceil(2 * F.col("n") * percent / (100 + percent))))
    long = inner.filter(F.col("both") * 100 >= percent * F.col("n"))
    within = _shared_places(short, long, ("shingle", "star"), percent).filter(_least(percent) <= F.least("both_a", "both_b"))
    return _enough(found.union(within.select(*names)))


def _outside(beyond: DataFrame, crowd: DataFrame, percent: int) -> DataFrame:
    """Pairs of one star that share a shingle beyond its centre among the first ones that the pair asks for."""
    rows = beyond.drop("n_star").join(crowd.select("cls", "n", "grp", "own"), "cls")
    a, b = _sides(rows, rows, ("star", "shingle"))
    more = _least(percent) - F.least("both_a", "both_b")
    inside = (F.col("pos_a") <= F.col("n_a") - F.col("both_a") - more) & (F.col("pos_b") <= F.col("n_b") - F.col("both_b") - more)
    return a.join(b, ["star", "shingle"]).filter(_ordered(percent) & (more > 0) & inside).select("cls_a", "cls_b", "own_a", "own_b")


def _counted(pairs: DataFrame, entries: DataFrame) -> DataFrame:
    """Pairs with ``shared``: how many entries of their whole prefixes they have in common."""
    lists = entries.groupBy("cls").agg(F.collect_list("shingle").alias("all"))  # a class has no more than its document's prefix
    both = pairs.join(lists.select(F.col("cls").alias("hub"), F.col("all").alias("all_hub")), "hub").join(lists, "cls")
    return both.withColumn("shared", F.size(F.array_intersect("all_hub", "all"))).drop("all", "all_hub")


def _mixed(shared: DataFrame, roots: DataFrame, crowd: DataFrame) -> DataFrame:
    """Entries, with their class's group, of shingles that classes of more than one group have.

    ``crowded``: the class is of a crowded star. ``meets``: a class of one has the shingle.
    """
    known = roots.select(F.col("node").alias("cls"), "root").join(crowd.select("cls", F.lit(True).alias("crowded")), "cls", "full")
    known = shared.join(known, "cls", "left").withColumn("grp", F.coalesce("root", "cls")).withColumn("crowded", F.coalesce("crowded", F.lit(False))).drop("root")
    several = known.groupBy("shingle").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi"), F.max("crowded").alias("meets"))
    return known.join(several.filter("lo != hi").select("shingle", "meets"), "shingle")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75) -> DataFrame:
    """(id, n_shingles, component_id) of every row; component_id is the smallest id that links reach, its own included."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    with Scratch(docs.sparkSession, "jaccard") as scratch:
        members, roots = classes_of(rows, scratch, words, percent)
        grouped = members.join(roots, "cls", "left").select("id", "n", F.coalesce("root", "cls").alias("grp"))
        grouped = scratch.save(grouped)
        firsts = grouped.filter("n > 0").groupBy("grp").agg(F.min("id").alias("component_id"))
        out = grouped.join(firsts, "grp", "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                                                        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
        return scratch.save(out, keep=True)
