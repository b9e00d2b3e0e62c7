"""Intermediate tables, folds and small helpers shared by the operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arspark.session import ensure_checkpoint_dir


class Scratch:
    """Intermediate tables in the shared folder ``spark.checkpoint.dir`` names.

    A saved table cuts the lineage: a lost executor costs only the tasks it
    ran. ``close`` deletes every table that wasn't saved with ``keep=True``; a
    kept table holds a query's rows until its folder is cleaned up.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self._n = 0
        self._open: dict[str, str] = {}

    def path(self, keep: bool = False) -> str:
        self._n += 1
        p = f"{self.root}/t{self._n}"
        if not keep:
            self._open[p] = p
        return p

    def save(self, df: DataFrame, keep: bool = False) -> DataFrame:
        p = self.path(keep)
        df.write.parquet(p)
        out = self.spark.read.schema(df.schema).parquet(p)
        out._scratch_path = p
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            p = self._open.pop(t._scratch_path, None)
            if p:
                self._delete(p)

    def _delete(self, path: str) -> None:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def close(self) -> None:
        for p in list(self._open):
            self._delete(self._open.pop(p))

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def trim() -> None:
    """Hand free memory of this process back to the system."""
    pa.default_memory_pool().release_unused()
    give = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library on Linux
    if give:
        give(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` over a task's batches; then the worker, which may wait idle beside others, hands its free memory back."""
    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            trim()
    return tidy


def crc_fold(id_col: str, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds``; a null id is in no fold (null)."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Words of 64 bits in the bitmap that picks candidates' rows before the exact join: at most this many rows are broadcast.
BITMAP = 1 << 18


def rows_with_ids(docs: DataFrame, ids: DataFrame, id_col: str, others: bool = False) -> DataFrame:
    """Rows of ``docs`` whose id may be among ``ids`` (column of that name): all that are, and a few others.

    ``others``: the remaining rows instead. The broadcast bitmap has ``BITMAP`` rows at most, whatever the tables.
    """
    h = F.xxhash64(F.col(id_col), F.lit(3))
    word, bit = F.pmod(h, F.lit(BITMAP)).cast("int"), F.pmod(F.shiftright(h, 40), F.lit(64)).cast("int")
    marked = ids.select(word.alias("__word"), bit.alias("__bit")).groupBy("__word").agg(F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__bits"))
    found = docs.withColumn("__word", word).withColumn("__bit", bit).join(F.broadcast(marked), "__word", "left")
    hit = F.expr("coalesce((shiftright(__bits, __bit) & 1L) = 1L, false)")
    return found.filter(~hit if others else hit).select(*docs.columns)
