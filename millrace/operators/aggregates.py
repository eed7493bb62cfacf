"""Grouped counts, averages and sums.

All of these aggregate map-side before the shuffle, so one key holding a third of the rows costs each task
a single extra row in the exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions import bucket_of
from millrace.operators.ranking import top_k


def summarise(
    df: DataFrame,
    keys: list[str],
    count: str | None = None,
    averages: dict[str, str] | None = None,
    sums: dict[str, str] | None = None,
    places: int | None = None,
    order: list[Column | str] | None = None,
) -> DataFrame:
    """Row count, averages and sums per key group; `averages` and `sums` map a column to its output name.

    A NULL key is a group of its own, `count` counts every row and averages skip NULLs. `places` rounds
    half-up.
    """

    def rounded(value: Column) -> Column:
        return value if places is None else F.round(value, places)

    outputs = [F.count("*").alias(count)] if count else []
    outputs += [rounded(F.sum(c)).alias(name) for c, name in (sums or {}).items()]
    outputs += [rounded(F.avg(c)).alias(name) for c, name in (averages or {}).items()]
    result = df.groupBy(*keys).agg(*outputs)
    return result.orderBy(*order) if order else result


def count_by(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def total_count(df: DataFrame, name: str = "count") -> DataFrame:
    """Number of rows, as a one-row frame."""
    return df.agg(F.count("*").alias(name))


def group_topn(df: DataFrame, keys: dict[str, str], value: str, n: int = 20) -> DataFrame:
    """The `n` largest groups by row count, with average and total of `value`.

    `keys` maps an output name to a column or a nested path such as `metadata.device`. Equal counts are
    ordered by the keys.
    """
    grouped = df.groupBy(*(F.col(path).alias(name) for name, path in keys.items())).agg(
        F.count("*").alias("count"), F.avg(value).alias("avg_value"), F.sum(value).alias("total_value")
    )
    return top_k(grouped, [F.desc("count"), *(F.asc(name) for name in keys)], n)


def error_lines(logs: DataFrame) -> DataFrame:
    """Log rows whose message mentions an error, in any case."""
    return logs.filter(F.lower("message").contains("error"))


def top_error_services(logs: DataFrame, n: int = 5) -> DataFrame:
    """The `n` services with most error lines as Service, Occurrences; equal counts by name."""
    counts = error_lines(logs).groupBy(F.col("service").alias("Service")).agg(F.count("*").alias("Occurrences"))
    return top_k(counts, [F.desc("Occurrences"), F.asc("Service")], n)


def distinct_services(logs: DataFrame) -> DataFrame:
    """Services with at least one error line."""
    return error_lines(logs).select("service").distinct()


def key_distribution(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Rows and percentage of all rows that hash placement by `keys` gives each of `n` buckets.

    The bucket is computed in place, so no row moves: only `n` counts per task are shuffled. Buckets
    without rows are absent, and an empty input gives no rows.
    """
    counts = df.groupBy(bucket_of(n, *keys).alias("bucket")).agg(F.count("*").alias("row_count"))
    # At most n rows from here on.
    everything = Window.partitionBy(F.lit(0))
    return counts.withColumn("pct", F.col("row_count") * 100.0 / F.sum("row_count").over(everything))
