"""Arg-max per group and top-k."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each group. Spark cuts each group to one row per task before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("place", F.row_number().over(window)).filter("place = 1").drop("place")


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The order should end in a key, so that ties are settled the same way on every run."""
    return df.orderBy(*order).limit(n)
