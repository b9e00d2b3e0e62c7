"""Table writes: batch replace, insert-if-absent, upsert (versioned), copies.

Plain Parquet tables have no MERGE/UPDATE/DELETE, so an upsert writes the
merged table as a *new version directory* and only then is the new version
read; a path is never overwritten while it is being read. Every write goes to
a path on shared storage given by the caller (on a cluster: never a
machine-local folder).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arspark.operators.latest import latest_per_key

#: Folders of a raw table, landed by batch or by stream: reads of recent loads, or of some offices, list only theirs.
RAW_PARTITIONS = ("OfficeID", "LoadDate")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def replace_batch(df: DataFrame, path: str) -> None:
    """Idempotent reload of (office, load time) batches of a raw table: rows of the batches in ``df`` replace those
    that the table holds of them, all others stay.

    A folder holds all loads of an office and day, so the other loads of the days at hand are read (only their
    folders are), written down together with the batch, and then the folders are replaced (dynamic partition
    overwrite). A reload that fails half way is simply run again."""
    spark = df.sparkSession
    incoming = f"{path.rstrip('/')}/_incoming-{uuid.uuid4().hex}"
    rows = df.withColumn("LoadDate", F.to_date("LoadDatetimeUTC"))
    rows.write.parquet(f"{incoming}/new")
    fresh = spark.read.schema(rows.schema).parquet(f"{incoming}/new")
    if _exists(spark, path):
        days, loads = (fresh.select("OfficeID", c).distinct() for c in ("LoadDate", "LoadDatetimeUTC"))
        held = read_raw_table(spark, path).join(days.withColumn("__day", F.lit(True)).filter("__day"), ["OfficeID", "LoadDate"], "left_semi")
        held.join(loads, ["OfficeID", "LoadDatetimeUTC"], "left_anti").select(*rows.columns).write.parquet(f"{incoming}/kept")
        fresh = fresh.union(spark.read.schema(rows.schema).parquet(f"{incoming}/kept"))
    fresh.repartition(*RAW_PARTITIONS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(*RAW_PARTITIONS).parquet(path)
    p = spark._jvm.org.apache.hadoop.fs.Path(incoming)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def read_raw_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a raw table written by :func:`replace_batch` or by the landing
    stream. The load date stays as a column, for filters that prune folders."""
    df = spark.read.parquet(path)
    return df.withColumn("LoadDatetimeUTC", F.col("LoadDatetimeUTC").cast("timestamp_ntz")) \
        .withColumn("OfficeID", F.col("OfficeID").cast("bigint"))


def new_rows(df: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` with no equal key in ``target`` (INSERT ... WHERE NOT EXISTS)."""
    return df.join(target.select(*keys), list(keys), "left_anti")


def append_new(df: DataFrame, target: DataFrame, keys: Sequence[str], path: str) -> None:
    new_rows(df, target, keys).write.mode("append").parquet(path)


def merge_latest(target: DataFrame, source: DataFrame, key, version: str = "lastLoadTime",
                 tie_breakers: Sequence[str] = ()) -> DataFrame:
    """MERGE semantics as a DataFrame: for every key keep the newest version
    from target or source (an older source row never replaces a newer target
    row, so replaying batches in any order gives the same table). At an equal
    version the source wins, so a corrected replay takes effect."""
    both = target.withColumn("__side", F.lit(0)).unionByName(source.withColumn("__side", F.lit(1)), allowMissingColumns=True)
    return latest_per_key(both, key, version, ["__side", *tie_breakers]).drop("__side")


def _versions(spark: SparkSession, path: str, committed: bool = True) -> list[int]:
    """Numbers of the version folders of a table; ``committed``: only those whose write ended."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("v=") and (not committed or fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))):
            out.append(int(name[2:]))
    return sorted(out)


def read_current(spark: SparkSession, path: str, schema=None, below: int | None = None) -> DataFrame | None:
    """The newest committed version of a versioned table (only versions
    < ``below`` when given), or None."""
    vs = [v for v in _versions(spark, path) if below is None or v < below]
    if not vs:
        return None
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(f"{path}/v={vs[-1]}")


def upsert(spark: SparkSession, path: str, source: DataFrame, key, version: str = "lastLoadTime",
           tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Merge ``source`` into the versioned table at ``path``; returns the new
    current version. The merged data is written to ``v=<n+1>`` (committed by
    the writer's _SUCCESS marker), so a failed job leaves ``v=<n>`` intact and a
    retry recomputes from it; folders of failed writes keep their numbers, and
    of two writers at once one fails, as a version is never overwritten."""
    cur = read_current(spark, path, source.schema)
    merged = latest_per_key(source, key, version, tie_breakers) if cur is None \
        else merge_latest(cur, source, key, version, tie_breakers)
    nxt = max(_versions(spark, path, committed=False), default=0) + 1
    merged.write.mode("error").parquet(f"{path}/v={nxt}")
    return spark.read.parquet(f"{path}/v={nxt}")


def write_table(df: DataFrame, path: str) -> None:
    """CREATE OR REPLACE TABLE ... AS SELECT (full refresh)."""
    df.write.mode("overwrite").parquet(path)


def copy_table(spark: SparkSession, src: str, dst: str) -> None:
    """Copy a table to a new layer (no zero-copy clone on Parquet)."""
    spark.read.parquet(src).write.mode("overwrite").parquet(dst)


def write_clustered(df: DataFrame, path: str, cols: Sequence[str], n_partitions: int | None = None) -> None:
    """Cluster a fact table by ``cols``: range-partition then sort inside each
    file, so min/max statistics prune row groups for filters on ``cols``."""
    out = df.repartitionByRange(n_partitions, *cols) if n_partitions else df.repartitionByRange(*cols)
    out.sortWithinPartitions(*cols).write.mode("overwrite").parquet(path)


def load_watermarks(raws: dict[str, DataFrame], quarantine: dict[str, DataFrame] | None = None) -> DataFrame:
    """Per (office, entity): last load time, rows loaded and bad rows, derived
    from the raw log and the quarantine (one aggregate per entity, unioned)."""
    quarantine = quarantine or {}
    parts = []
    for entity, raw in raws.items():
        g = raw.groupBy("OfficeID").agg(F.max("LoadDatetimeUTC").alias("lastRunTimestamp"),
                                        F.count(F.lit(1)).alias("rowsLoaded"))
        if entity in quarantine:
            b = quarantine[entity].groupBy("OfficeID").agg(F.count(F.lit(1)).alias("badRows"))
            g = g.join(b, "OfficeID", "left")
        else:
            g = g.withColumn("badRows", F.lit(None).cast("bigint"))
        parts.append(g.select("OfficeID", F.lit(entity).alias("entity"), "lastRunTimestamp", "rowsLoaded",
                              F.coalesce(F.col("badRows"), F.lit(0)).alias("badRows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
