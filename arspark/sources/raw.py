"""Raw landing: JSON records stamped with office and load time.

Raw rows are ``(OfficeID bigint, LoadDatetimeUTC timestamp_ntz, RawData variant)``;
before parsing, the payload is carried as text (``RawDataString``) so
unparsable records can be counted and quarantined instead of failing the load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

RAW_TEXT_SCHEMA = StructType([StructField("OfficeID", LongType()), StructField("LoadDatetimeUTC", TimestampNTZType()),
                              StructField("RawDataString", StringType())])


def read_raw(spark: SparkSession, path: str, office: int, load_ts) -> DataFrame:
    """JSON-lines files -> raw text rows stamped with office and load time."""
    txt = spark.read.text(path)
    return txt.select(F.lit(office).cast("bigint").alias("OfficeID"),
                      F.lit(load_ts).cast("timestamp_ntz").alias("LoadDatetimeUTC"),
                      F.col("value").alias("RawDataString"))


def to_raw(df: DataFrame, office: Column, load_ts: Column, payload_cols=None) -> DataFrame:
    """Serialise DataFrame rows as raw JSON records (one record per row)."""
    cols = payload_cols or df.columns
    return df.select(office.cast("bigint").alias("OfficeID"), load_ts.cast("timestamp_ntz").alias("LoadDatetimeUTC"),
                     F.to_json(F.struct(*[F.col(c) for c in cols])).alias("RawDataString"))


def parse_raw(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split raw text rows into parsed rows (``RawData`` variant) and a
    quarantine of rows whose text is not valid JSON."""
    # inline: the text is parsed once, whatever filters and columns follow
    p = df.select("*", F.inline(F.array(F.struct(F.try_parse_json("RawDataString").alias("RawData")))))
    good = p.filter(F.col("RawData").isNotNull()).drop("RawDataString")
    bad = p.filter(F.col("RawData").isNull()).drop("RawData")
    return good, bad


def bad_json_count(df: DataFrame) -> DataFrame:
    """Unparsable records per office (partial aggregation, one row per office)."""
    return df.groupBy("OfficeID").agg(
        F.count_if(F.try_parse_json("RawDataString").isNull()).alias("badRows"),
        F.count(F.lit(1)).alias("totalRows"))


def bad_json_sample(df: DataFrame, n: int = 5, width: int = 200) -> DataFrame:
    """The first ``width`` characters of up to ``n`` bad records (a sample is
    the feature here, so the limit is intended)."""
    bad = df.filter(F.try_parse_json("RawDataString").isNull())
    return bad.select("OfficeID", F.left("RawDataString", F.lit(width)).alias("sample")).limit(n)


def explode_records(df: DataFrame, plural: str) -> DataFrame:
    """API responses hold records under a plural key (``{"customers": [...]}``),
    under ``propertyNameData`` (list or id->record object) or as a bare list.
    Returns one raw row per record."""
    v = F.col("RawData")
    arr = F.coalesce(
        F.try_variant_get(v, f"$.{plural}", "array<variant>"),
        F.try_variant_get(v, "$.propertyNameData", "array<variant>"),
        F.map_values(F.try_variant_get(v, "$.propertyNameData", "map<string,variant>")),
        F.try_variant_get(v, "$", "array<variant>"))
    return df.select("OfficeID", "LoadDatetimeUTC", F.explode(arr).alias("RawData"))


def standardize_raw(df: DataFrame) -> DataFrame:
    """Keep exactly the three raw columns (drops legacy extras such as _loaded_at)."""
    return df.select("OfficeID", "LoadDatetimeUTC", "RawData")
