"""Helpers shared by the marts."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def as_date(as_of) -> Column:
    """The report date (the warehouse's CURRENT_DATE) as a literal DATE column."""
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Money is summed as exact DECIMAL inside the plan; results are exposed as
    DOUBLE (the warehouse's FLOAT)."""
    cols = [F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
            else F.col(f"`{f.name}`") for f in df.schema.fields]
    return df.select(*cols)


def count_when(cond: Column) -> Column:
    """COUNT(CASE WHEN cond THEN 1 END)."""
    return F.count(F.when(cond, F.lit(1)))


def sum_when(cond: Column, value, otherwise=0) -> Column:
    """SUM(CASE WHEN cond THEN value ELSE otherwise END)."""
    v = F.col(value) if isinstance(value, str) else value
    return F.sum(F.when(cond, v).otherwise(F.lit(otherwise)))


def avg_exact(col) -> Column:
    """AVG computed as double(SUM) / COUNT so the result does not depend on the
    engine's decimal-average rounding."""
    c = F.col(col) if isinstance(col, str) else col
    n = F.count(c)
    return F.when(n > 0, F.sum(c).cast("double") / n)
