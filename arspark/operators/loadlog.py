"""A log of landed batches, from which load reports are made.

Landing a batch of an entity appends one row for each office and load time it
holds: how many records, and how many of them are no JSON. A batch is one
folder, ``entity=<name>/batch=<id>``, committed by the writer's marker; a batch
that is landed again finds its folder and counts once, and one whose write died
is written anew. Reports read these few rows, never the records.

A log of :func:`loads` has no count of records that are no JSON; it serves
reports that don't name them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "OfficeID long, LoadDatetimeUTC timestamp_ntz, records long, bad long, entity string, batch string"


def committed(spark: SparkSession, path: str, entity: str, batch: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/entity={entity}/batch={batch}/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def counts(raw: DataFrame) -> DataFrame:
    """Records and unparsable ones of raw text rows, per office and load time."""
    return raw.groupBy("OfficeID", "LoadDatetimeUTC").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.try_parse_json("RawDataString").isNull()).alias("bad"))


def loads(raw: DataFrame) -> DataFrame:
    """Records of raw rows, per office and load time: the texts aren't read."""
    return raw.groupBy("OfficeID", "LoadDatetimeUTC").agg(F.count(F.lit(1)).alias("records"))


def append(spark: SparkSession, path: str, entity: str, batch: str, raw: DataFrame, count: Callable[[DataFrame], DataFrame] = counts) -> bool:
    """Log a landed batch of raw text rows; False if it was logged before. ``count``: what is logged, :func:`counts` or :func:`loads`."""
    if committed(spark, path, entity, batch):
        return False
    count(raw).write.mode("overwrite").parquet(f"{path}/entity={entity}/batch={batch}")
    return True


def append_same(spark: SparkSession, path: str, entity: str, batch: str, of: str) -> bool:
    """Log a batch that is also a batch of another entity, already logged: its records are not counted again."""
    if committed(spark, path, entity, batch):
        return False
    spark.read.parquet(f"{path}/entity={of}/batch={batch}").write.mode("overwrite").parquet(f"{path}/entity={entity}/batch={batch}")
    return True


def read(spark: SparkSession, path: str, entities: Iterable[str] = ("*",)) -> DataFrame:
    """(entity, OfficeID, LoadDatetimeUTC, records, bad) over all committed batches, one row a load; ``entities``: of these only."""
    log = spark.read.schema(SCHEMA).option("basePath", path).parquet(*(f"{path}/entity={e}/batch=*" for e in entities))
    return log.groupBy("entity", "OfficeID", "LoadDatetimeUTC").agg(F.sum("records").alias("records"), F.sum("bad").alias("bad"))


def watermarks(log: DataFrame) -> DataFrame:
    """Per office and entity: last run, last run that brought a readable record, records, unreadable ones."""
    return log.groupBy(F.col("OfficeID").alias("office_id"), F.col("entity").alias("entity_name")).agg(
        F.max("LoadDatetimeUTC").alias("last_run_utc"),
        F.max(F.when(F.col("records") > F.col("bad"), F.col("LoadDatetimeUTC"))).alias("last_success_utc"),
        F.sum("records").alias("records_loaded"), F.sum("bad").alias("error_count"))
