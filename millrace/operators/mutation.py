"""Keyed increments: a batch of updates, each of which changes one matching row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.sizing import broadcastable, sized_join
from millrace.session import materialise


def increment_targets(
    df: DataFrame,
    updates: DataFrame,
    key: str,
    order: list[str],
    carry: list[str] | None = None,
    only_updated: bool = False,
) -> DataFrame:
    """The row that each updated key's increment goes to: `_key`, `_at_...` per order column, `_updates`, and `carry`.

    With `only_updated`, rows of keys without an update are left out before the first rows are sought.
    """
    carry = carry or []
    counts = updates.groupBy(key).agg(F.count("*").alias("_updates"))
    if only_updated:
        counts = materialise(counts)
        keys = counts.select(F.col(key).alias("_key"))
        df = df.join(broadcastable(keys) or keys, F.col(key) == F.col("_key"), "left_semi")
    columns = [*order, *carry]
    # A plain min keeps hash aggregation; a struct min sorts, so it is used for composite orders only.
    smallest = F.min(F.struct(*columns)) if len(columns) > 1 else F.struct(F.min(order[0]).alias(order[0]))
    first = df.groupBy(key).agg(smallest.alias("_first"))
    return counts.join(first, key).select(
        F.col(key).alias("_key"),
        *(F.col(f"_first.{c}").alias(f"_at_{c}") for c in order),
        *(F.col(f"_first.{c}") for c in carry),
        "_updates",
    )


def apply_increments(
    df: DataFrame,
    targets: DataFrame,
    key: str,
    order: list[str],
    value: str,
    step: int = 1,
    stamp: Column | None = None,
    stamp_col: str = "lastUpdate",
) -> DataFrame:
    """`df` with the increments of `increment_targets` made; rows that none goes to stay as they are."""
    match = reduce(Column.__and__, (F.col(c) == F.col(f"_at_{c}") for c in order), F.col(key) == F.col("_key"))
    joined = sized_join(df, targets, match, "left")
    touched = F.col("_updates").isNotNull()
    increased = F.col(value) + F.lit(step) * F.coalesce(F.col("_updates"), F.lit(0))
    result = joined.withColumn(value, increased.cast(df.schema[value].dataType))
    columns = list(df.columns)
    if stamp is not None:
        previous = F.col(stamp_col) if stamp_col in columns else F.lit(None)
        result = result.withColumn(stamp_col, F.when(touched, stamp).otherwise(previous))
        columns += [] if stamp_col in columns else [stamp_col]
    return result.select(*columns)


def increment_first(
    df: DataFrame,
    updates: DataFrame,
    key: str,
    order: list[str],
    value: str,
    step: int = 1,
    stamp: Column | None = None,
    stamp_col: str = "lastUpdate",
) -> DataFrame:
    """Add `step` per update to the first row, by `order`, of the update's key.

    `order` must be free of NULLs and identify a row within its key. Updates without a matching row
    change nothing. With `stamp`, the touched rows get it in `stamp_col`, which is NULL or unchanged
    elsewhere.
    """
    targets = increment_targets(df, updates, key, order)
    return apply_increments(df, targets, key, order, value, step, stamp, stamp_col)
