"""Nested queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.sizing import sized_join


def above_average(df: DataFrame, value: str) -> DataFrame:
    """Rows whose `value` is over the average of all rows (scalar subquery, no shuffle of rows)."""
    overall = df.agg(F.avg(value))
    return df.filter(F.col(value) > overall.scalar())


def above_group_average(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rows whose `value` is over the average of their own key (correlated subquery, decorrelated).

    Rows with a NULL key equal no group and are not returned.
    """
    averages = df.groupBy(key).agg(F.avg(value).alias("_average"))
    joined = sized_join(df, averages, [key], "inner")
    return joined.filter(F.col(value) > F.col("_average")).select(*df.columns)
