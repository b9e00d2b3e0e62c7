"""Conversations as a trie of turns: what conversations share, and what sharing would save.

* Dictionary. A turn (role, text) is known by its 128-bit digest and by the
  length of its text; texts are read once and go no further than the sort that
  puts a conversation's turns in order.
* Shards. Conversations, as sequences of turn digests, are dealt out by ranges
  of (sequence, id). A sequence that very many conversations share is split
  between shards by their ids.
* Trees. A task gives its shard's distinct turns dense ids in their order and
  puts the sequences into a ternary search tree (each node: a turn, links to
  smaller and larger turns in the same place, a link to the next place). They
  are inserted median first, which keeps the trees of a place balanced. One
  traversal with a stack of its own then sums members, leaves and savings up.
* Boundaries. Only nodes on the path of a shard's first or last sequence can
  lie in other shards too. Their sums are left open: a shard tells what its own
  closed nodes below them hold. Equal boundary nodes meet by a digest of their
  path, and what is below them is summed by pointer jumping, in as many passes
  as the longest path has binary digits.

Defined results: a null role or text is empty; turns of a conversation are
ordered by number, null first, ties by role and text; repeated rows are turns
like others; rows without a conversation id belong to none and are left out; an
empty table has no conversations, so not even a root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arspark.llm.common import Scratch, released

#: Bytes of a turn's digest; turns a shard holds on average; bytes of joined ids in one piece.
WIDTH, SHARD_TURNS, PIECE = 16, 1 << 18, 1 << 20
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and turn; out comes a conversation a row."""
    conv, turns, sizes = None, [], []
    names = ["conv_id", "turns", "sizes"]

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([b"".join(turns)], pa.binary()),
                                           pa.array([b"".join(sizes)], pa.binary())], names)
    for batch in batches:
        ids = batch.column("conv_id").to_numpy()
        if not len(ids):
            continue
        head = np.flatnonzero(np.diff(ids, prepend=ids[0] - 1))
        whole = pa.concat_arrays([batch.column("turn")])
        size = batch.column("size").to_numpy().astype("<i8")
        out: list[list] = [[], [], []]
        for a, b in zip(head.tolist(), np.append(head[1:], len(ids)).tolist()):
            if conv is not None and conv != ids[a]:
                for x, v in zip(out, (conv, b"".join(turns), b"".join(sizes))):
                    x.append(v)
                turns, sizes = [], []
            conv = int(ids[a])
            turns.extend(whole.slice(a, b - a).to_pylist())
            sizes.append(size[a:b].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())], names)
    if conv is not None:
        yield row()


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns, sizes) of each conversation: digests and text bytes of its turns in order."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    rows = turns.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("at"), role.alias("role"), text.alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("at").asc_nulls_first(), "role", "text")
    digest = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")))
    return rows.select("conv_id", digest.alias("turn"), F.octet_length("text").cast("long").alias("size")).mapInArrow(
        released(_in_order), "conv_id long, turns binary, sizes binary")


def grafted(convs: DataFrame, span: int = 5, shares: int = 9) -> DataFrame:
    """Each conversation c with the first h turns of conversation c - c % ``span`` in place of its own; h = crc32(c) % ``shares``."""
    own = convs.withColumn("h", F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(shares)).cast("int")).withColumn("base", F.expr(f"conv_id - conv_id % {span}"))
    most = shares - 1  # no more turns are ever taken over
    base = convs.select(F.col("conv_id").alias("base"), F.substring("turns", 1, WIDTH * most).alias("base_turns"), F.substring("sizes", 1, 8 * most).alias("base_sizes"))

    def joined(first: str, rest: str, width: int) -> Column:
        return F.expr(f"concat(coalesce(substring({first}, 1, {width} * h), X''), substring({rest}, {width} * h + 1))")
    return own.join(base, "base", "left").select("conv_id", joined("base_turns", "turns", WIDTH).alias("turns"), joined("base_sizes", "sizes", 8).alias("sizes"))


class Tree:
    """A ternary search tree of turn sequences, as parallel arrays; node 0 is the textless root."""

    def __init__(self):
        self.turn, self.size, self.depth, self.up = array("q", [-1]), array("q", [0]), array("q", [0]), array("q", [-1])
        self.less, self.more, self.down = array("q", [-1]), array("q", [-1]), array("q", [-1])

    def child(self, node: int, turn: int, size: int) -> int:
        """The node below ``node`` for this turn, made if there is none."""
        at, link, place = self.down[node], self.down, node
        while at >= 0:
            here = self.turn[at]
            if turn == here:
                return at
            link, place = (self.less, at) if turn < here else (self.more, at)
            at = link[place]
        made = len(self.turn)
        for x, v in ((self.turn, turn), (self.size, size), (self.depth, self.depth[node] + 1), (self.up, node), (self.less, -1), (self.more, -1), (self.down, -1)):
            x.append(v)
        link[place] = made
        return made

    def insert(self, turns: list[int], sizes: list[int]) -> int:
        node = 0
        for t, s in zip(turns, sizes):
            node = self.child(node, t, s)
        return node

    def children_first(self) -> Iterator[int]:
        """Nodes so that each comes after all below it: a node is made after its parent."""
        return iter(range(len(self.turn) - 1, -1, -1))


def medians(n: int) -> Iterator[int]:
    """0 to n - 1, the middle of each range before what is left and right of it."""
    stack = [(0, n)]
    while stack:
        a, b = stack.pop()
        if a < b:
            m = (a + b) // 2
            yield m
            stack += [(m + 1, b), (a, m)]


def _tree_rows(convs: list[int], turns: list[bytes], sizes: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Nodes of one shard, whose rows are sorted by (turns, conv_id)."""
    flat = np.frombuffer(b"".join(turns), dtype=f"S{WIDTH}") if any(turns) else np.zeros(0, f"S{WIDTH}")
    dense = np.unique(flat, return_inverse=True)[1]  # the shard's dictionary: ids in the digests' order
    first = np.cumsum([0] + [len(t) // WIDTH for t in turns])
    new = [k for k in range(len(turns)) if not k or turns[k] != turns[k - 1]]
    after = [*new[1:], len(turns)]
    tree, ends = Tree(), {}
    for m in medians(len(new)):
        k = new[m]
        ends[tree.insert(dense[first[k]:first[k + 1]].tolist(), np.frombuffer(sizes[k], "<i8").tolist())] = (k, after[m])
    n = len(tree.turn)
    open_ = bytearray(n)  # nodes that other shards may have too, and the digests of their paths
    paths: dict[int, bytes] = {0: hashlib.md5(b"").digest()}
    open_[0] = 1
    for k in {0, len(turns) - 1}:
        node = 0
        for t, s, raw in zip(dense[first[k]:first[k + 1]].tolist(), np.frombuffer(sizes[k], "<i8").tolist(), range(first[k], first[k + 1])):
            below = tree.child(node, t, s)
            if not open_[below]:
                open_[below] = 1
                paths[below] = hashlib.md5(paths[node] + turns[k][(raw - first[k]) * WIDTH:(raw - first[k] + 1) * WIDTH]).digest()
            node = below
    members, least, children, leaves, saved = (array("q", bytes(8 * n)) for _ in range(5))
    for node in range(n):
        least[node] = 1 << 62
    for node in tree.children_first():
        if node in ends:
            a, b = ends[node]
            members[node] += b - a
            least[node] = min(least[node], convs[a])
        up = tree.up[node]
        if not open_[node]:
            leaves[node] += not children[node]
            saved[node] += (members[node] - 1) * tree.size[node]
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
        if up >= 0:
            members[up] += members[node]
            least[up] = min(least[up], least[node])
    nothing = hashlib.sha256(b"").hexdigest()
    out: list[list] = [[] for _ in range(12)]

    def batch() -> pa.RecordBatch:
        kinds = [*(pa.int64(),) * 7, pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.binary()]
        made = pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], COLUMNS)
        for x in out:
            x.clear()
        return made

    def add(*row) -> bool:
        for x, v in zip(out, row):
            x.append(v)
        return len(out[0]) >= 1 << 13

    held = 0
    for node in range(n):
        up, end = tree.up[node], ends.get(node)
        key, up_key = paths.get(node), paths.get(up)
        row = (least[node], tree.depth[node], None if up < 0 or open_[up] else least[up], members[node], children[node], leaves[node], saved[node])
        if not open_[node]:
            sha = hashlib.sha256(",".join(map(str, convs[end[0]:end[1]])).encode()).hexdigest() if end else nothing
            if add(*row, sha, None, up_key, None, None):
                yield batch()
            continue
        if add(*row, None, key, up_key, tree.size[node], None):
            yield batch()
        at, last = end or (0, 0)
        while at < last:  # ids that end here, in pieces: depth -1 tells them from nodes
            text = ",".join(map(str, convs[at:min(last, at + PIECE // 20)])).encode()
            add(convs[at], -1, None, 0, 0, 0, 0, None, key, None, None, text)
            at, held = at + PIECE // 20, held + len(text)
            if held > PIECE:
                yield batch()
                held = 0
    yield batch()


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "path", "up_path", "size", "ends"]


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    shard = TaskContext.get().partitionId()
    convs, turns, sizes = [], [], []
    for b in batches:
        convs += b.column("conv_id").to_pylist()
        turns += b.column("turns").to_pylist()
        sizes += b.column("sizes").to_pylist()
    if convs:
        for b in _tree_rows(convs, turns, sizes):
            yield b.append_column("shard", pa.array(np.full(b.num_rows, shard)))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of joined ids sorted by (path, first id): the digest of each path's ids."""
    path, sha, out = None, None, [[], []]
    for b in batches:
        for p, piece in zip(b.column("path").to_pylist(), b.column("ends").to_pylist()):
            if p != path:
                if path is not None:
                    out[0].append(path)
                    out[1].append(sha.hexdigest())
                path, sha = p, hashlib.sha256(piece)
            else:
                sha.update(b"," + piece)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.string())], ["path", "sha"])
        out = [[], []]
    if path is not None:
        yield pa.RecordBatch.from_arrays([pa.array([path], pa.binary()), pa.array([sha.hexdigest()])], ["path", "sha"])


def _summed(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """Boundary nodes with n_leaves and saved_tokens of all below them, by pointer jumping."""
    now = scratch.save(nodes.withColumn("far", F.col("up_path")))
    while not now.filter("far IS NOT NULL").isEmpty():
        told = now.filter("far IS NOT NULL").groupBy(F.col("far").alias("path")).agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
        jump = now.select(F.col("path").alias("far"), F.col("far").alias("next"))
        more = now.join(told, "path", "left").join(jump, "far", "left")
        rest = [c for c in now.columns if c not in ("far", "n_leaves", "saved_tokens")]
        after = scratch.save(more.select(*rest, (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"),
                                         (F.col("saved_tokens") + F.coalesce("s", F.lit(0))).alias("saved_tokens"), F.col("next").alias("far")))
        scratch.drop(now)
        now = after
    return now.drop("far")


def trie(convs: DataFrame) -> DataFrame:
    """A row for each node of the trie of ``convs`` (conv_id, turns, sizes): columns of ``NODE``."""
    spark = convs.sparkSession
    with Scratch(spark, "prefix-trie") as scratch:
        convs = scratch.save(convs)
        turns = convs.agg(F.sum(F.octet_length("turns"))).first()[0] or 0
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), turns // (WIDTH * SHARD_TURNS) + 1)
        dealt = convs.repartitionByRange(shards, "turns", "conv_id").sortWithinPartitions("turns", "conv_id")
        found = scratch.save(dealt.mapInArrow(released(_trees), f"{NODE}, path binary, up_path binary, size long, ends binary, shard long"))
        pieces = found.filter("depth < 0").select("path", "conv_id", "ends").repartition("path").sortWithinPartitions("path", "conv_id")
        ends = pieces.select("path", "ends").mapInArrow(released(_ends), "path binary, sha string")
        part = found.filter("path IS NOT NULL AND depth >= 0")
        whole = part.groupBy("path").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.first("up_path").alias("up_path"), F.first("size").alias("size"),
                                         *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")))
        below = whole.filter("up_path IS NOT NULL").groupBy(F.col("up_path").alias("path")).agg(F.count(F.lit(1)).alias("more"))
        whole = whole.join(below, "path", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
        whole = whole.withColumn("n_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("long"))
        whole = whole.withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size")).drop("more", "size")
        whole = _summed(whole, scratch)
        names = whole.select(F.col("path").alias("up_path"), F.col("conv_id").alias("up_conv"))
        columns = [c.split()[0] for c in NODE.split(", ")]
        no_ends = F.lit(hashlib.sha256(b"").hexdigest())
        border = whole.join(names, "up_path", "left").join(ends, "path", "left").withColumn("parent_conv_id", F.col("up_conv")).withColumn("ends_sha256", F.coalesce("sha", no_ends))
        # a shard's closed nodes get their open parents' names by (shard, path): no path has a hot group
        known = part.select("shard", F.col("path").alias("up_path")).join(names, "up_path")
        closed = found.filter("path IS NULL").join(known, ["shard", "up_path"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "up_conv"))
        return scratch.save(border.select(*columns).unionByName(closed.select(*columns)), keep=True)


#: The same nodes from the definition: every prefix of every rebuilt conversation, grouped; subtrees by a join of leaves with their prefixes.
ORACLE = r"""
WITH ordered AS (
    SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS said
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), shares AS (  -- crc32 of the decimal id, bit by bit: a byte's code, then eight shifts (-1)
    SELECT conv_id, said, (xor(list_reduce(
        flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
        lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, 4294967295::BIGINT), 4294967295) % 9)::BIGINT AS h
    FROM ordered
), rebuilt AS (
    SELECT s.conv_id, list_concat(coalesce(b.said, [])[1:s.h], s.said[s.h + 1:]) AS said
    FROM shares s LEFT JOIN ordered b ON b.conv_id = s.conv_id - s.conv_id % 5
), prefixes AS (
    SELECT conv_id, k AS depth, len(said) AS whole, said[1:k] AS path
    FROM (SELECT conv_id, said, unnest(range(0, len(said) + 1)) AS k FROM rebuilt)
), nodes AS (
    SELECT path, any_value(depth)::BIGINT AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           CASE WHEN any_value(depth) = 0 THEN 0 ELSE (count(*) - 1) * strlen(any_value(path[-1].t)) END AS saves,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (whole = depth), '')) AS ends_sha256
    FROM prefixes GROUP BY path
), kin AS (
    SELECT n.*, p.conv_id AS parent_conv_id, coalesce(k.n, 0) AS n_children
    FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
    LEFT JOIN (SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1) k ON k.path = n.path
), sums AS (
    SELECT top, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saves) AS saved
    FROM (SELECT n_children, saves, path[1:k] AS top FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM kin)) GROUP BY top
)
SELECT conv_id, depth, parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, ends_sha256
FROM kin JOIN sums ON sums.top = kin.path
"""
