import datetime as dt
import json
import os

from pyspark.sql import functions as F

from arspark.functions.dates import utc_to_local
from arspark.operators import sinks
from arspark.plans.ar import month_series
from arspark.sources.raw import parse_raw, read_raw, standardize_raw
from arspark.streaming.ingest import land_files, read_raw_stream, write_raw_stream


def test_read_raw_files(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "pull.jsonl")
    with open(path, "w") as f:
        f.write(json.dumps({"customerID": 1}) + "\n{broken\n")
    raw = read_raw(spark, path, 7, dt.datetime(2024, 1, 1, 3))
    good, bad = parse_raw(raw)
    assert [r.OfficeID for r in good.collect()] == [7] and bad.count() == 1
    assert standardize_raw(good.withColumn("_loaded_at", F.current_timestamp())).columns == \
        ["OfficeID", "LoadDatetimeUTC", "RawData"]


def test_month_series(spark):
    rows = month_series(spark, "2024-03-15", 12).orderBy("n").collect()
    assert len(rows) == 12 and rows[0].reportMonth == dt.date(2024, 3, 1)
    assert rows[1].monthEnd == dt.date(2024, 2, 29) and rows[11].reportMonth == dt.date(2023, 4, 1)


def test_tz_shift(spark):
    v = spark.range(1).select(utc_to_local(F.lit(dt.datetime(2024, 7, 1, 12, 0)).cast("timestamp_ntz")).alias("x"))
    assert v.collect()[0].x == dt.datetime(2024, 7, 1, 5, 0)


def test_write_and_copy_table(spark, tmpdir_path):
    a, b = os.path.join(tmpdir_path, "a"), os.path.join(tmpdir_path, "b")
    sinks.write_table(spark.range(5), a)
    sinks.write_table(spark.range(3), a)  # full refresh replaces
    sinks.copy_table(spark, a, b)
    assert spark.read.parquet(b).count() == 3


def test_stream_landing(spark, tmpdir_path):
    src, out, ck = (os.path.join(tmpdir_path, x) for x in ("in", "out", "ck"))
    rows = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 3), '{"a": 1}'), (2, dt.datetime(2024, 1, 2, 3), "{bad")],
                                 "OfficeID bigint, LoadDatetimeUTC timestamp_ntz, RawDataString string")
    land_files(rows, src)
    q = write_raw_stream(read_raw_stream(spark, src), out, ck)
    q.awaitTermination()
    landed = spark.read.parquet(out)
    assert landed.count() == 1 and set(landed.columns) >= {"OfficeID", "LoadDate", "RawData"}
    assert [r.RawDataString for r in spark.read.parquet(out + "_quarantine").collect()] == ["{bad"]
    assert dict(sinks.read_raw_table(spark, out).dtypes)["LoadDatetimeUTC"] == "timestamp_ntz"
