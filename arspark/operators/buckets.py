"""Versioned tables in hash buckets: an upsert rewrites only the buckets its keys fall into.

Layout of a table folder::

    _manifests/<version>.json   what the version is made of: schema, keys, folder of each bucket
    data/<write>/bucket=<k>/    files of the buckets that one write replaced

A key's bucket is ``pmod(hash(key), n)``, fixed when the table is made (``xxhash64`` in
tables of older manifests). This is how Spark deals rows out by key into ``n`` partitions, so the
one shuffle that finds each key's newest row also puts a bucket's rows into one task. An
upsert deals its batch out, merges each bucket that got rows with that
bucket's current files, writes the merged buckets into a folder of its own, and
then commits: a manifest that names the new folders for those buckets and the
old ones for all others is renamed into place. A rename that would replace a
manifest fails, so of two writers that start from the same version one commits
and the other gets :class:`ConcurrentUpsert`; a write that dies before its
commit leaves the table as it was. What reaches the driver is the number of a
bucket or the name of a folder, as many as the table has buckets.

The table's folder must be on a file system whose rename is atomic and doesn't
replace, as Spark's own streaming checkpoints ask for.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from arspark.operators.latest import latest_per_key
from arspark.session import FREE_SHUFFLES, INITIAL, settings

BUCKET = "bucket"


class ConcurrentUpsert(RuntimeError):
    """Another writer committed the version first; run the upsert again."""


@dataclass
class Manifest:
    version: int
    n: int
    keys: list[str]
    order: str
    schema: str
    buckets: dict[str, str] = field(default_factory=dict)  # bucket -> the write whose folder holds it
    batches: dict[str, int] = field(default_factory=dict)  # source of numbered batches -> the last one merged
    by: str = "xxhash64"  # function of the keys that names the bucket; manifests from before it was written have this one

    @property
    def struct(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


class _Files:
    """The few file operations that Spark's readers and writers don't have."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        self.conf = spark._jsc.hadoopConfiguration()
        self.root = path.rstrip("/")
        self.fs = self.at("").getFileSystem(self.conf)

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str) -> list[str]:
        p = self.at(name)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a file whole or not at all; False if it is there already."""
        tmp = self.at(f"{name}.{uuid.uuid4().hex}.tmp")
        out = self.fs.create(tmp, True)
        out.write(bytearray(text.encode()))
        out.close()
        rename = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
        rename[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.NONE
        target = self.at(name)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        try:
            context.rename(tmp, target, rename)
            return True
        except Exception:  # py4j wraps the file system's own error
            if self.fs.exists(target):
                self.fs.delete(tmp, False)
                return False
            raise

    def modified(self, name: str) -> float:
        return self.fs.getFileStatus(self.at(name)).getModificationTime() / 1000

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(x[:-5]) for x in _Files(spark, path).names("_manifests") if x.endswith(".json"))


def manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest | None:
    """That of a version (default: the newest), or None if the table isn't there."""
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        return None
    return Manifest(**json.loads(_Files(spark, path).read(f"_manifests/{known[-1] if version is None else version}.json")))


def _of(keys: Sequence[str], n: int, by: str) -> Column:
    return F.pmod({"hash": F.hash, "xxhash64": F.xxhash64}[by](*keys), F.lit(n)).cast("int")


def _write(rows: DataFrame, folder: str, n: int) -> None:
    """Write rows by bucket. Shuffles below have ``n`` partitions, a bucket each, and their files go once the rows are written."""
    with settings(rows.sparkSession, {"spark.sql.shuffle.partitions": str(n), INITIAL: str(n), FREE_SHUFFLES: "true"}):
        rows.write.partitionBy(BUCKET).parquet(folder)


def _rows(spark: SparkSession, path: str, m: Manifest, buckets: Sequence[str], schema: StructType) -> DataFrame:
    folders = [f"{path.rstrip('/')}/data/{m.buckets[b]}/{BUCKET}={b}" for b in buckets if b in m.buckets]
    # a column that older files don't have is NULL in them
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """Rows of a version (default: the newest); None if the table or the version isn't there."""
    m = manifest(spark, path, version)
    return None if m is None else _rows(spark, path, m, list(m.buckets), m.struct)


def read_changed(spark: SparkSession, path: str, since: int) -> DataFrame | None:
    """Rows of the newest version that lie in buckets rewritten after version ``since``: all rows that changed are among them."""
    old, new = manifest(spark, path, since), manifest(spark, path)
    if new is None:
        return None
    was = old.buckets if old else {}
    return _rows(spark, path, new, [b for b, w in new.buckets.items() if was.get(b) != w], new.struct)


def _merged_schema(old: StructType | None, new: StructType) -> StructType:
    fields = list(old.fields) if old else []
    have = {f.name.lower() for f in fields}
    return StructType(fields + [f for f in new.fields if f.name.lower() not in have])


def upsert(spark: SparkSession, path: str, source: DataFrame, key, order: str = "lastLoadTime", tie_breakers: Sequence[str] = (),
           buckets: int = 64, batch: tuple[str, int] | None = None) -> DataFrame:
    """Merge ``source`` into the table; returns the rows of its new version.

    Of each key the newest row by ``order`` stays, at equal order the source's; keys are never
    removed. ``buckets`` counts when the table is made. ``batch``: (source, number) of a numbered
    batch; one that was merged before is left out, so a replay adds no version. An empty batch
    adds none either, but makes a table that isn't there."""
    keys = [key] if isinstance(key, str) else list(key)
    files, current = _Files(spark, path), manifest(spark, path)
    if current and current.keys != keys:
        raise ValueError(f"the table's keys are {current.keys}")
    if current and batch and current.batches.get(batch[0], -1) >= batch[1]:
        return read(spark, path)
    n, by = (current.n, current.by) if current else (buckets, "hash")
    schema = _merged_schema(current.struct if current else None, source.schema)
    write = uuid.uuid4().hex
    incoming, folder = f"{files.root}/_incoming/{write}", f"{files.root}/data/{write}"
    def newest(rows: DataFrame, ties: Sequence[str]) -> DataFrame:
        if by == "hash":
            return latest_per_key(rows, keys, order, ties).withColumn(BUCKET, _of(keys, n, by))
        return latest_per_key(rows.withColumn(BUCKET, _of(keys, n, by)).repartition(n, BUCKET), [BUCKET, *keys], order, ties)

    landing = incoming if current else folder  # the first write has nothing to be merged with: it is written once
    _write(newest(source, tie_breakers), landing, n)
    touched = [x.split("=")[1] for x in files.names(f"_incoming/{write}" if current else f"data/{write}") if x.startswith(f"{BUCKET}=")]
    if touched and current:
        fresh = spark.read.schema(StructType([*source.schema.fields])).parquet(incoming)
        held = [b for b in touched if b in current.buckets]
        if held:
            old = _rows(spark, path, current, held, current.struct).withColumn("__side", F.lit(0))
            both = old.unionByName(fresh.withColumn("__side", F.lit(1)), allowMissingColumns=True)
            merged = newest(both, ["__side", *tie_breakers]).drop("__side")
        else:
            merged = fresh.withColumn(BUCKET, _of(keys, n, by)).repartition(n, BUCKET)
        _write(merged.select(*(f.name for f in schema.fields), BUCKET), folder, n)
    files.delete(f"_incoming/{write}")
    if not touched and current and not batch:
        return read(spark, path)
    after = Manifest(current.version + 1 if current else 1, n, keys, order, schema.json(), {**(current.buckets if current else {}), **{b: write for b in touched}},
                     {**(current.batches if current else {}), **({batch[0]: batch[1]} if batch else {})}, by)
    if not files.create(f"_manifests/{after.version}.json", json.dumps(asdict(after))):
        files.delete(f"data/{write}")
        raise ConcurrentUpsert(f"version {after.version} of {path} was committed by another writer")
    return read(spark, path, after.version)


def retain(spark: SparkSession, path: str, keep: int = 2, older_than_s: float = 86_400) -> list[str]:
    """Forget all but the last ``keep`` versions and delete folders of data that none of them uses.

    Folders younger than ``older_than_s`` stay: a write that hasn't committed may own them."""
    files = _Files(spark, path)
    known = versions(spark, path)
    used = {w for v in known[-keep:] for w in manifest(spark, path, v).buckets.values()}
    for v in known[:-keep]:
        files.delete(f"_manifests/{v}.json")
    gone = []
    for top in ("data", "_incoming"):
        for write in files.names(top):
            if write not in used and files.modified(f"{top}/{write}") <= time.time() - older_than_s:
                files.delete(f"{top}/{write}")
                gone.append(write)
    return gone
