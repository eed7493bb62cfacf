"""Streaming sources.

Everything downstream works on a frame with a `value` column, so a file stream replaces a topic in tests.
The Kafka connector is a separate jar (`spark-sql-kafka-0-10`) that the session must bring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_topic(
    spark: SparkSession,
    topic: str,
    servers: str = "localhost:9092",
    starting: str = "latest",
    group_id: str | None = None,
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Kafka topic as a stream of key, value, topic, partition, offset, timestamp."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if group_id:
        reader = reader.option("kafka.group.id", group_id)
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load()


def stream_table(
    spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet table, a single file or a folder, as a stream of its files.

    The file source takes folders and patterns only; a pattern that matches just `path` covers both cases.
    """
    path = path.rstrip("/")
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")
