"""Top-k, limits, per-key ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.operators.rows import numbered
from millrace.plans.sizing import broadcastable, small_by_estimate
from millrace.session import materialise, plan_bytes, size_setting

# Candidate rows that the one task which merges a top-k may receive before a merge level is put in front.
MERGE_ROWS = 10_000_000
MERGE_GROUPS = 512


def rank_limit(df: DataFrame, keys: list[str], order: list[Column | str], k: int) -> DataFrame:
    """The first `k` rows per key.

    Spark plans this as a group limit before and after the exchange, so a task sends at most `k` rows of a
    key however many it holds. `order` must not leave ties if the result is to be repeatable.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).filter(F.col("_position") <= k).drop("_position")


def top_k(df: DataFrame, order: list[Column | str], k: int) -> DataFrame:
    """The first `k` rows by `order`, sorted.

    Every task keeps `k` rows and one task merges them. Where the input has so many splits that the merge
    would see more than MERGE_ROWS rows, groups of tasks merge first, and where even those would send it too
    many, the input is sorted by ranges and numbered. The rows found are the same if `order` leaves no ties.
    """
    split = df.sparkSession.conf.get("spark.sql.files.maxPartitionBytes")
    tasks = plan_bytes(df) // size_setting(split) + 1
    if tasks * k > MERGE_ROWS and MERGE_GROUPS * k > MERGE_ROWS:
        return numbered(df, order, "_place").filter(F.col("_place") <= k).orderBy("_place").drop("_place")
    if tasks * k > MERGE_ROWS:
        grouped = df.withColumn("_group", F.spark_partition_id() % MERGE_GROUPS)
        df = rank_limit(grouped, ["_group"], order, k).drop("_group")
    return df.orderBy(*order).limit(k)


def limit_rows(df: DataFrame, n: int, order: list[Column | str] | None = None) -> DataFrame:
    """`n` rows: the first ones by `order`, or any if there is none, which stops reading early."""
    return top_k(df, order, n) if order else df.limit(n)


def preview(df: DataFrame, n: int = 10, order: list[Column | str] | None = None) -> DataFrame:
    """A few rows to look at; the schema is `df.schema`."""
    return limit_rows(df, n, order)


def first_k_per_key(
    df: DataFrame, keys: DataFrame, key: str, order: list[Column | str], k: int = 10
) -> DataFrame:
    """Bulk lookup: up to `k` rows of `df` for every key value in `keys`.

    A key set that fits is broadcast and filters the scan before the ranking. A larger one is joined after
    the ranking, when every key is down to `k` rows, so no hot key is ever shuffled whole; its range of values is
    pushed to the scan, and where the scan is large Spark puts a Bloom filter of the set on it, below the ranking.
    """
    wanted = keys.select(key).distinct()
    if not small_by_estimate(wanted):
        wanted = materialise(wanted)
    small = broadcastable(wanted)
    if small is not None:
        return rank_limit(df.join(small, key, "left_semi"), [key], order, k)
    # The range is a filter on both sides: Spark builds a Bloom filter only of a side that has one.
    within = F.col(key).between(*(F.lit(end) for end in wanted.agg(F.min(key), F.max(key)).first()))
    return rank_limit(df.filter(within), [key], order, k).join(wanted.filter(within), key, "left_semi")


def latest_versions(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The newest `n` versions of each row key; `order` is newest first and ends in a tie-break."""
    return rank_limit(df, keys, order, n)
