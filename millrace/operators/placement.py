"""Data placement that the user chooses. Use it only for a frame that is read more than once."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def cache_table(df: DataFrame) -> tuple[DataFrame, int]:
    """Cache and materialise; returns the cached frame and its row count. Call `unpersist` when done.

    Blocks that do not fit in memory go to disk; blocks of a lost executor are computed again.
    """
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    return cached, cached.count()


def repartition_evenly(df: DataFrame, n: int) -> DataFrame:
    """`n` partitions of about the same size."""
    return df.repartition(n)


def repartition_by_key(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """`n` hash partitions by key, shared by later joins and groupings on it.

    Worth it for keys of high cardinality only: a hot key ends up in one partition.
    """
    return df.repartition(n, *keys)
