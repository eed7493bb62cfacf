"""Stream outputs. Checkpoints belong in the shared folder, see `millrace.session.scratch_path`.

`trigger` is passed to `DataStreamWriter.trigger`, for example `{"availableNow": True}`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from millrace.operators.ranking import rank_limit
from millrace.session import delete_path, matching_paths, path_exists

# Results of a complete-mode stream that stay readable.
SNAPSHOTS = 3


def to_messages(df: DataFrame, key: str, fields: list[str], keep: tuple[str | Column, ...] = ()) -> DataFrame:
    """Key and JSON value of each row; NULL fields are left out of the JSON."""
    return df.select(
        *keep, F.col(key).cast("string").alias("key"), F.to_json(F.struct(*fields)).alias("value")
    )


def _writer(df: DataFrame, checkpoint: str, trigger: dict | None) -> DataStreamWriter:
    writer = df.writeStream.option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger) if trigger else writer


def write_topic(
    df: DataFrame, topic: str, checkpoint: str, servers: str = "localhost:9092", trigger: dict | None = None
) -> StreamingQuery:
    """Append key/value messages to a Kafka topic; needs the Kafka connector jar."""
    return (
        _writer(df, checkpoint, trigger)
        .format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .start()
    )


def write_files(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append rows as Parquet files, exactly once."""
    return _writer(df, checkpoint, trigger).format("parquet").option("path", path).start()


def write_updates(
    df: DataFrame, checkpoint: str, mode: str = "update", trigger: dict | None = None
) -> StreamingQuery:
    """Print changed rows of an aggregate, untruncated."""
    writer = _writer(df, checkpoint, trigger).format("console")
    return writer.outputMode(mode).option("truncate", "false").start()


def write_batch(batch: DataFrame, path: str, batch_id: int) -> None:
    """A micro-batch as a folder of its own. A batch that is replayed after it was finished stays as it is."""
    folder = f"{path}/batch_id={batch_id}"
    if not path_exists(batch.sparkSession, f"{folder}/_SUCCESS"):
        batch.write.mode("overwrite").parquet(folder)


def _finished(spark: SparkSession, path: str, name: str) -> dict[int, str]:
    """Folders `name` + number under `path` that are written to the end."""
    folders = (f.rsplit("/", 1)[0] for f in matching_paths(spark, f"{path}/{name}*/_SUCCESS"))
    return {int(folder.rsplit(name, 1)[1]): folder for folder in folders}


def finished_batches(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the batches that are written to the end, with their `batch_id`; raises if there is none."""
    folders = [mark.rsplit("/", 1)[0] for mark in matching_paths(spark, f"{path}/batch_id=*/_SUCCESS")]
    if not folders:
        raise FileNotFoundError(f"no finished batch under {path}")
    return spark.read.option("basePath", path).parquet(*folders)


def _write_batches(
    df: DataFrame,
    path: str,
    checkpoint: str,
    mode: str,
    trigger: dict | None,
    history: int | None = None,
) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id)
        if history and batch_id >= history:
            delete_path(batch.sparkSession, f"{path}/batch_id={batch_id - history}")

    return _writer(df, checkpoint, trigger).outputMode(mode).foreachBatch(write).start()


def write_update_log(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Changed rows of an aggregate as a table that keeps each batch; read it with `latest_updates`.

    The log grows with every batch; `write_upserts` keeps the current rows only.
    """
    return _write_batches(df, path, checkpoint, "update", trigger)


def latest_updates(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The current row of each key of an update log."""
    return rank_limit(finished_batches(spark, path), keys, [F.desc("batch_id")], 1).drop("batch_id")


def write_snapshot(
    df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, history: int = SNAPSHOTS
) -> StreamingQuery:
    """The whole result of an aggregate after each of the last `history` batches; read it with `read_snapshot`.

    Complete mode keeps every group in the state, also those behind the watermark. For windows on a stream that
    never ends use `write_update_log`, which lets closed windows go.
    """
    return _write_batches(df, path, checkpoint, "complete", trigger, history)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The result after the last batch."""
    batches = finished_batches(spark, path)
    return batches.filter(F.col("batch_id") == batches.agg(F.max("batch_id")).scalar()).drop("batch_id")
