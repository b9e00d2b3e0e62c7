"""Structured Streaming: continuous landing, dedupe of overlapping change
windows, upsert into the typed table, and a quarantine for bad JSON.

Landed files are JSON lines with the raw envelope
``{"OfficeID": .., "LoadDatetimeUTC": "..", "RawDataString": "<record>"}``.
The change pulls overlap (a window re-reads the last 15 minutes of the
previous one), so the same record version arrives more than once.

State and progress live in the checkpoint folder (on shared storage: by default
under ``spark.checkpoint.dir``), so a restarted query resumes where it stopped
and a lost executor only re-runs its tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from arspark.operators import buckets as tables
from arspark.operators.spec import EntitySpec
from arspark.operators.stage import stage
from arspark.session import FREE_SHUFFLES, scratch_path, settings
from arspark.sources.raw import parse_raw

RAW_ENVELOPE_SCHEMA = StructType([StructField("OfficeID", LongType()), StructField("LoadDatetimeUTC", StringType()),
                                  StructField("RawDataString", StringType())])


def read_raw_stream(spark: SparkSession, src_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of raw text rows from landed JSON-lines files (explicit schema,
    no inference)."""
    r = spark.readStream.schema(RAW_ENVELOPE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.json(src_dir)
    return df.select("OfficeID", F.col("LoadDatetimeUTC").cast("timestamp_ntz").alias("LoadDatetimeUTC"),
                     "RawDataString")


def write_raw_stream(df: DataFrame, out_dir: str, checkpoint: str, quarantine_dir: str | None = None):
    """Continuous landing into a raw table, one folder per office and load date;
    rows that aren't JSON go to ``quarantine_dir`` (default: ``<out_dir>_quarantine``).

    A file sink writes every row exactly once but has one folder, so there are
    two queries, each with its own checkpoint: a file that arrives between them
    is read by the other one on its next run. The quarantine is written first;
    returned is the running query of the parsed rows."""
    base = out_dir.rstrip("/")
    good, bad = parse_raw(df.withColumn("LoadDate", F.to_date("LoadDatetimeUTC")))

    def sink(rows: DataFrame, progress: str, path: str):
        return rows.writeStream.format("parquet").option("checkpointLocation", progress) \
            .partitionBy("OfficeID", "LoadDate").trigger(availableNow=True).start(path)
    sink(bad, f"{checkpoint.rstrip('/')}_quarantine", quarantine_dir or f"{base}_quarantine").awaitTermination()
    return sink(good, checkpoint, out_dir)


def dedupe_stream(df: DataFrame, key_path: str, version_path: str = "$.dateUpdated",
                  watermark: str = "3 hours") -> DataFrame:
    """Drop repeated (key, version) records within the watermark. Event time
    must be a zoned timestamp for watermarks, so the load time is cast. The
    watermark (3 h) exceeds the 2 h 15 min pull window plus overlap."""
    v = F.try_parse_json("RawDataString")
    # a record without a key or version (unparsable ones too) is told apart by its own text
    keyed = df.withColumn("_k", F.coalesce(F.try_variant_get(v, key_path, "string"), F.sha2("RawDataString", 256))) \
        .withColumn("_ver", F.coalesce(F.try_variant_get(v, version_path, "string"), F.sha2("RawDataString", 256))) \
        .withColumn("_event_time", F.col("LoadDatetimeUTC").cast("timestamp"))
    return keyed.withWatermark("_event_time", watermark) \
        .dropDuplicatesWithinWatermark(["_k", "_ver"]).drop("_k", "_ver", "_event_time")


def _batch_upsert(spec: EntitySpec, target_path: str, quarantine_path: str, buckets: int, held: bool, keep: int | None):
    def fn(batch: DataFrame, epoch_id: int):
        spark = batch.sparkSession
        if batch.isEmpty():  # a run that has nothing new leaves the target as it is
            return
        # the micro-batch feeds two writes (quarantine, merge): landed files are read for each of them, as a copy of their
        # texts would fill the executors' disks; only what came through a stream's state is held
        if held:
            batch = batch.persist()
        st = stage(batch, spec)
        # epochs start anew with a new checkpoint, so a folder is named by the checkpoint's query id too
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        st.bad_json.withColumn("query", F.lit(query)).withColumn("epoch", F.lit(epoch_id)).write.mode("overwrite") \
            .parquet(f"{quarantine_path.rstrip('/')}/part={query}-{epoch_id}")
        # the target remembers a checkpoint's last epoch: one that is replayed after its commit is left out
        tables.upsert(spark, target_path, st.rows, spec.keys, tie_breakers=spec.tie_breakers, buckets=buckets, batch=(query, epoch_id))
        if keep:
            tables.retain(spark, target_path, keep, older_than_s=0)
        if held:
            batch.unpersist()
    return fn


def run_upsert_stream(spark: SparkSession, src_dir: str, spec: EntitySpec, target_path: str,
                      quarantine_path: str, checkpoint: str | None = None, dedupe: bool = False, buckets: int = 64,
                      max_files_per_trigger: int | None = None, keep: int | None = None):
    """Land -> (dedupe) -> per micro-batch: quarantine bad JSON, merge the
    newest version per key into the bucketed target, which rewrites only the
    buckets that the batch's keys fall into. Runs what is available
    and stops (``availableNow``); schedule it for continuous operation.

    Nothing is dropped before the merge, which is idempotent by itself: records
    that arrive twice, late records and unparsable rows all reach it or the
    quarantine. Versions are numbered by the target, so a new checkpoint on an
    old target and batch upserts between two runs add to it. ``dedupe`` saves merge work but drops rows later than its
    watermark, so it is off unless asked for. ``keep``: versions of the target that stay; for a target
    with this one writer, and no reader of older ones.
    """
    checkpoint = checkpoint or scratch_path(spark, f"stream-{spec.name}")
    df = read_raw_stream(spark, src_dir, max_files_per_trigger)
    if dedupe:
        df = dedupe_stream(df, f"$.{spec.keys[0]}")
    q = df.writeStream.foreachBatch(_batch_upsert(spec, target_path, quarantine_path, buckets, dedupe, keep)) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def land_files(df: DataFrame, out_dir: str, n_files: int | None = 1) -> None:
    """Write raw text rows as envelope JSON-lines files, gzipped (test/bench helper); ``n_files=None``: one for
    each partition that ``df`` has, so that the texts aren't shuffled. Shuffle files go once the files are written."""
    rows = df.select("OfficeID", F.date_format("LoadDatetimeUTC", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("LoadDatetimeUTC"), "RawDataString")
    with settings(df.sparkSession, {FREE_SHUFFLES: "true"}):
        (rows.repartition(n_files) if n_files else rows).write.mode("append").json(out_dir, compression="gzip")


def current_rows(spark: SparkSession, target_path: str, columns: Sequence[str]) -> DataFrame | None:
    cur = tables.read(spark, target_path)
    return None if cur is None else cur.select(*columns)
