"""Readers for the driver parquet tables.

Every reader returns a lazy DataFrame; Catalyst prunes the columns a plan does
not use and pushes filters into the parquet scan, so selecting early is not
needed here.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from arspark.session import INITIAL

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


@dataclass
class Tables:
    spark: SparkSession
    root: str
    _cache: dict = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(os.path.join(self.root, f"{name}.parquet"))
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLE_NAMES:
            raise AttributeError(name)
        return self.table(name)


#: Bytes of the tables' files for each piece of a job over all of them.
PIECE_BYTES = 8 << 20


def pieces(spark: SparkSession, root: str) -> int:
    """Pieces that a job over all tables is cut into, so that a task's share keeps its size as the tables grow."""
    jvm, total = spark._jvm, 0
    for name in ("customer", "supplier", "part", "orders", "lineitem", "events"):
        p = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}.parquet")
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        total += fs.getContentSummary(p).getLength() if fs.exists(p) else 0
    return -(-total // PIECE_BYTES)


def load_tables(spark: SparkSession, root: str) -> Tables:
    """Table readers for ``root``: files are listed anew for each call, so a long session sees new ones."""
    # partitions that shuffles start with: the session's own number or more; AQE puts small ones together again
    n = pieces(spark, root)
    if n > int(spark.conf.get(INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL, str(n))
    # Timestamps in these files are zone-less (TIMESTAMP_NTZ); pin UTC anyway so
    # any zone-aware conversion gives the same answer on every executor.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return Tables(spark, root)
