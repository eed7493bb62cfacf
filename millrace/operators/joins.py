"""Equi-joins. NULL keys match nothing, as in SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.rows import sample_rows
from millrace.plans.sizing import sized_join


def join_count(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Number of rows of `left JOIN right USING (keys)`, without building the join.

    A key with a rows on one side and b on the other yields a * b join rows, so counting each side per key
    is enough: two map-side aggregations and a join of one row per key. The result is DECIMAL(38,0), for
    the count of a large self-join leaves the BIGINT range.
    """

    def per_key(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.count("*").cast("decimal(19,0)").alias(name))

    pairs = per_key(left, "_left").join(per_key(right, "_right"), keys)
    product = (F.col("_left") * F.col("_right")).cast("decimal(38,0)")
    return pairs.agg(F.coalesce(F.sum(product), F.lit(0)).cast("decimal(38,0)").alias("join_rows"))


def self_join_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of rows of the join of `df` with itself on `keys`; reads `df` once."""
    matchable = reduce(Column.__and__, (F.col(k).isNotNull() for k in keys))
    counts = df.filter(matchable).groupBy(*keys).agg(F.count("*").cast("decimal(19,0)").alias("_n"))
    square = (F.col("_n") * F.col("_n")).cast("decimal(38,0)")
    return counts.agg(F.coalesce(F.sum(square), F.lit(0)).cast("decimal(38,0)").alias("join_rows"))


def sample_join_count(
    df: DataFrame, keys: list[str], fraction: float, seeds: tuple[int, int], by: list[str] | None = None
) -> DataFrame:
    """Join count of two independent samples of `df`."""
    left, right = (sample_rows(df, fraction, seed, by) for seed in seeds)
    return join_count(left, right, keys)


def dim_join(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows with the columns of their dimension row.

    There is no hint: Catalyst broadcasts a dimension below `spark.sql.autoBroadcastJoinThreshold`, and
    beyond it sort-merges, with AQE splitting hot keys.
    """
    return fact.join(dim, key)


def in_other(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in `other` (IN subquery).

    The keys of `other` are made distinct, so that a hot one of its is a single row, and computed before the
    join unless they are small, so that AQE can split a hot key of `df`.
    """
    return sized_join(df, other.select(key).distinct(), [key], "left_semi")
