"""Nearest neighbours by vantage-point trees, one tree for each shard of the vectors.

Largest inner product becomes smallest Euclidean distance by one more
coordinate: with M the largest norm, x -> (x, sqrt(M^2 - |x|^2)) and
q -> (q, 0) give |q - x|^2 = |q|^2 + M^2 - 2 q.x. Trees split at the median
distance from a vantage point. A search skips a side when the triangle
inequality shows that it holds nothing nearer than the k-th found:
``factor`` relaxes that bound. A factor of 1 skips only what can't matter, so
the search is exact; a larger factor skips more (distances to the border times
the factor) and may miss neighbours.

Every row is indexed: shards of about ``shard_rows`` rows by a hash of the id.
Queries go in blocks of at most ``block_rows`` to every shard (a stated query
set against all rows); a shard answers a block with its own k nearest, by exact
inner products in double precision, and the k best of all shards remain.

Defined results: vectors that are null, zero, of another length than most, or
hold null or non-finite components take no part; ties go to the smaller id; a
query is no candidate of its own id; fewer candidates than k give fewer rows;
rows that repeat a (id, vector) count once; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arspark.llm.common import Scratch, released

LEAF = 128


class Tree:
    """Vantage-point tree over the rows of ``x``; rows are kept in leaf order."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, top: float):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        extra = np.sqrt(np.maximum(0.0, top - np.einsum("ij,ij->i", self.x, self.x)))
        self.lifted = np.concatenate([self.x, extra[:, None]], axis=1)
        self.nodes: list[tuple] = []
        self.root = self._build(np.arange(len(ids)), np.random.default_rng(len(ids)))

    def _build(self, rows: np.ndarray, rng) -> int:
        k = len(self.nodes)
        self.nodes.append(())
        if len(rows) <= LEAF:
            self.nodes[k] = (None, rows)
            return k
        # of a few vantage points, the one whose distances spread most
        tried = rng.choice(rows, min(8, len(rows)), replace=False)
        some = self.lifted[rows[:256]]
        vantage = max(tried.tolist(), key=lambda v: np.linalg.norm(some - self.lifted[v], axis=1).std())
        d = np.linalg.norm(self.lifted[rows] - self.lifted[vantage], axis=1)
        by = np.argsort(d, kind="stable")
        half = len(rows) // 2
        near, far = rows[by[:half]], rows[by[half:]]
        border = (d[by[half - 1]], d[by[half]])  # the largest distance inside, the smallest outside
        self.nodes[k] = (vantage, border, self._build(near, rng), self._build(far, rng))
        return k

    def search(self, qid: np.ndarray, q: np.ndarray, k: int, factor: float) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the ids and inner products of its k nearest, nearest first, ties to the smaller id."""
        lifted = np.concatenate([q, np.zeros((len(q), 1))], axis=1)
        best = [(np.zeros(0, np.int64), np.zeros(0))] * len(q)
        bound = np.full(len(q), np.inf)  # distance of the k-th found
        last = np.full(len(q), -np.inf)  # its inner product
        top = (self.lifted[0] @ self.lifted[0]) if len(self.ids) else 0.0
        norms = np.einsum("ij,ij->i", q, q)
        slack = 1e-9 * (1.0 + np.sqrt(norms + top))  # rounding must not skip a tie

        def visit(node: int, active: np.ndarray, floor: np.ndarray) -> None:
            """``floor``: a lower bound of the distance from each active query to anything below the node."""
            keep = floor * factor <= bound[active] + slack[active]
            active, floor = active[keep], floor[keep]
            if not len(active):
                return
            found = self.nodes[node]
            if found[0] is None:
                rows = found[1]
                got = np.einsum("qd,rd->qr", q[active], self.x[rows])
                better = np.flatnonzero(got.max(axis=1) >= last[active])
                for a, scores in zip(active[better].tolist(), got[better]):
                    own = self.ids[rows] != qid[a]
                    ids, s = np.concatenate([best[a][0], self.ids[rows][own]]), np.concatenate([best[a][1], scores[own]])
                    take = np.lexsort((ids, -s))[:k]
                    best[a] = ids[take], s[take]
                    if len(take) == k:
                        last[a] = s[take[-1]]
                        bound[a] = np.sqrt(max(0.0, norms[a] + top - 2 * s[take[-1]]))
                return
            vantage, (inner, outer), near, far = found
            d = np.linalg.norm(lifted[active] - self.lifted[vantage], axis=1)
            to_near, to_far = np.maximum(floor, d - inner), np.maximum(floor, outer - d)
            first = d <= (inner + outer) / 2
            for part, sides in ((first, ((near, to_near), (far, to_far))), (~first, ((far, to_far), (near, to_near)))):
                for child, low in sides:
                    if part.any():
                        visit(child, active[part], low[part])

        if len(self.ids):
            visit(self.root, np.arange(len(q)), np.zeros(len(q)))
        return best


def _matrix(col, dim: int) -> np.ndarray:
    return np.array(col.to_list(), dtype=np.float64).reshape(-1, dim)


def _plant(dim: int, top: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = Tree(pdf["id"].to_numpy(np.int64), _matrix(pdf["v"], dim), top)
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "tree": [pickle.dumps(tree)]})
    return run


def _gather(dim: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "queries": [pickle.dumps((pdf["id"].to_numpy(np.int64), _matrix(pdf["v"], dim)))]})
    return run


def _search(k: int, factor: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, b in zip(batch.column("tree"), batch.column("queries")):
                tree, (qid, q) = pickle.loads(t.as_py()), pickle.loads(b.as_py())
                found = tree.search(qid, q, k, factor)
                n = [len(x) for x, _ in found]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(qid, n)), pa.array(np.concatenate([x for x, _ in found])),
                                                  pa.array(np.concatenate([s for _, s in found]))], ["query_id", "id", "score"])
    return run


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int, float]:
    """(id, v) of vectors that take part, their length and the largest squared norm."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.transform(F.col(vector_col), lambda x: x.cast("double")).alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
    rows = rows.filter(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size(v).alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)).alias("top")) \
        .orderBy(F.desc("n"), "d").first()
    if sizes is None:
        return rows, 0, 0.0
    return rows.filter(F.size(v) == sizes["d"]), sizes["d"], sizes["top"]


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, factor: float = 1.0, id_col: str = "vec_id", vector_col: str = "embedding",
            shard_rows: int = 4096, block_rows: int = 1024) -> DataFrame:
    """(query_id, rank, id, score) of the k nearest rows of each row where ``is_query`` (over ``id``) holds."""
    spark = vectors.sparkSession
    rows, dim, top = usable(vectors, id_col, vector_col)
    schema = T.StructType.fromDDL("query_id long, rank int, id long, score double")
    if not dim:
        return spark.createDataFrame([], schema)
    with Scratch(spark, "vp") as scratch:
        rows = scratch.save(rows.distinct())
        n = rows.count()
        n_query = rows.filter(is_query).count()
        shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-n_query // block_rows))
        dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(shards)).cast("int"))
        trees = scratch.save(dealt.groupBy("shard").applyInPandas(_plant(dim, top), "shard int, tree binary"))
        asked = rows.filter(is_query).withColumn("block", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(blocks)).cast("int"))
        packed = asked.groupBy("block").applyInPandas(_gather(dim), "block int, queries binary")
        # each block goes to each shard by the shard's number
        sent = packed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        jobs = sent.join(trees, "shard").repartition(shards * blocks, "shard", "block").select("tree", "queries")
        found = scratch.save(jobs.mapInArrow(released(_search(k, factor)), "query_id long, id long, score double"), keep=True)
    return best_of(found, k)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query; a query has at most k rows from each shard."""
    from pyspark.sql import Window
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")
