"""Joins that SQL has and the DataFrame API doesn't."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_in(df: DataFrame, key: str, others: DataFrame, other_key: str) -> DataFrame:
    """Rows of ``df`` with ``key NOT IN (SELECT other_key FROM others)``, NULLs as SQL has them.

    A NULL in the list leaves no row, a NULL key never passes, and an empty list lets every row
    pass, NULL keys too. Spark plans the SQL text as a null-aware join that sends the whole list
    to every task, or as a nested loop; here the list is a side of an ordinary anti join, and one
    row that counts it decides about NULLs."""
    listed = others.select(F.col(other_key).alias("__k"))
    held = listed.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count_if(F.col("__k").isNull()).alias("nulls")))
    left = df.join(listed.filter("__k IS NOT NULL"), F.col(key) == F.col("__k"), "left_anti").withColumn("__held", held.scalar())
    return left.filter((F.col("__held.n") == 0) | ((F.col("__held.nulls") == 0) & F.col(key).isNotNull())).drop("__held")
