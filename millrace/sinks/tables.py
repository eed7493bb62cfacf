"""Batch table outputs and layouts."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import matching_sizes, plan_bytes

# Tables that are joined on their bucket keys need no exchange if one's number of buckets divides the other's.
BUCKET_BYTES = 256 << 20
# Files and estimates of few columns say little about what the task that sorts or groups a bucket holds; its rows do.
BUCKET_ROWS = 1 << 20
MAX_BUCKETS = 20_000
# A bucket beyond this is too much for the one task that reads it.
LARGEST_BUCKET = 4 << 30


def append_table(df: DataFrame, path: str) -> None:
    """Add rows to a Parquet table; every task writes its own files. `append_rows` knows a batch that it has added before."""
    df.write.mode("append").parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Drop the table's rows and write new ones. Readers may find neither meanwhile; `replace_rows` has no such gap."""
    df.write.mode("overwrite").parquet(path)


def write_partitioned(df: DataFrame, path: str, columns: list[str]) -> None:
    """One folder per value of `columns`; partitions that `df` does not touch stay as they are.

    REBALANCE brings the rows of a partition value together and splits a value too large for one task, so
    there are neither tasks x values small files nor one task writing a hot value alone. An empty text raises
    while writing: as a folder name it would come back as NULL. Read the table back with its schema.
    """
    refuse = F.raise_error(F.lit("an empty text cannot be a partition value"))
    texts = [c for c, kind in df.dtypes if c in columns and kind == "string"]
    df = df.withColumns({c: F.when(F.col(c) == "", refuse).otherwise(F.col(c)) for c in texts})
    (
        df.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def bucket_count(df: DataFrame) -> int:
    """Buckets of about BUCKET_BYTES each, by Catalyst's estimate of the frame, and of about BUCKET_ROWS at most.

    Rows are counted; of a plain Parquet scan that reads the footers only.
    """
    return max(1, min(MAX_BUCKETS, max(-(-plan_bytes(df) // BUCKET_BYTES), -(-df.count() // BUCKET_ROWS))))


def write_bucketed(
    df: DataFrame, name: str, key: str, path: str, n: int | None = None, largest: int = LARGEST_BUCKET
) -> DataFrame:
    """Path-backed table of `n` hash buckets, sized by the frame if not given.

    Grouping or joining it on `key` needs no exchange. REBALANCE into `n` hash partitions puts one bucket into
    one partition, and AQE lets several tasks write a hot one. A bucket is read by one task, so if one has more
    than `largest` bytes the frame returned scans the files without regard to buckets.
    """
    n = n or bucket_count(df)
    (
        df.hint("rebalance", n, key)
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(n, key)
        .sortBy(key)
        .saveAsTable(name)
    )
    bucketed = df.sparkSession.table(name)
    sizes: dict[str, int] = {}
    for file, size in matching_sizes(df.sparkSession, f"{path}/part-*").items():
        # Spark puts the bucket's number before the extension.
        bucket = re.search(r"_(\d{5,})\.", file.rsplit("/", 1)[1]).group(1)
        sizes[bucket] = sizes.get(bucket, 0) + size
    if max(sizes.values(), default=0) > largest:
        return df.sparkSession.read.schema(bucketed.schema).parquet(path)
    return bucketed


def register_external(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Table over the Parquet files at `path`; dropping it leaves the files."""
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{location}'")
    return spark.table(name)


def write_csv_report(df: DataFrame, path: str) -> None:
    """CSV with a header. A top-n is one partition already and becomes one file, in order."""
    df.write.mode("overwrite").csv(path, header=True)
