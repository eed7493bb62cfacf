"""Sensor stream: decode, alert and count. One read of the stream feeds all outputs, which change together."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.rules import ALERT_TEMPERATURE
from millrace.operators.rows import build_alerts
from millrace.sinks.stored import commit, expire_versions, merged_files, new_files, read_stored, stored_version, table_of
from millrace.sinks.streams import to_messages
from millrace.sources.messages import decode_json
from millrace.sources.schemas import SENSOR_READING, TRANSACTION
from millrace.streaming.windows import flat_window

ALERTS, COUNTS, LATE = "alerts", "window_counts", "late_readings"
WINDOW_KEYS = ["window_start", "window_end", "sensor_id"]


def parse_readings(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Sensor readings with `event_time` from a stream or table of messages."""
    return decode_json(raw, SENSOR_READING, keep=keep)


def parse_transactions(raw: DataFrame) -> DataFrame:
    """Transactions with `event_time` from a stream or table of messages."""
    return decode_json(raw, TRANSACTION)


def alert_messages(readings: DataFrame, temperature: float = ALERT_TEMPERATURE) -> DataFrame:
    """Alerts keyed by sensor, as JSON. Stateless: every task handles its own messages."""
    alerts = build_alerts(readings, temperature)
    return to_messages(alerts, "sensor_id", ["sensor_id", "temperature", "status", "alert_msg"])


def _hour(column: str) -> Column:
    """Number of the hour that a time is in: counts of recent windows touch the latest hours' files only."""
    return F.floor(F.unix_seconds(F.col(column).cast("timestamp")) / 3600).cast("int")


def add_counts(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return old.unionByName(new).groupBy(*keys).agg(F.sum("critical_count").alias("critical_count"))


def start_alerts_and_counts(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    width: str = "5 seconds",
    delay: str = "5 seconds",
    temperature: float = ALERT_TEMPERATURE,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Alerts, critical readings per window and sensor, and readings that came too late, into one store at `path`.

    Each micro-batch is read once, and one version makes all that it adds visible, with its number and the watermark:
    after a crash between two outputs neither is visible, and a batch that is replayed after its version adds nothing.
    As in `critical_window_counts`, critical readings advance the watermark, in milliseconds, and a reading is late if
    its window had ended by the watermark of the batches before; late readings, the rows that a watermarked aggregation
    drops, are kept as a table, so counted and late readings together are all critical ones with a time.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = stored_version(spark, path)
        if before.notes.get("batch", -1) >= batch_id:
            return
        batch = batch.persist(StorageLevel.DISK_ONLY)
        try:
            messages = alert_messages(batch, temperature)
            critical = batch.filter((F.col("status") == "critical") & F.col("event_time").isNotNull())
            windowed = critical.withColumn("window", F.window("event_time", width))
            mark = before.notes.get("watermark_ms", 0)
            over = F.col("window.end") <= F.timestamp_millis(F.lit(mark))
            newest = F.unix_millis(F.max("event_time") - F.expr(f"INTERVAL '{delay}'"))
            reached, n_late = windowed.agg(newest, F.count_if(over)).first()
            late = windowed.filter(over).drop("window")
            added = windowed.filter(~over).groupBy("window", "sensor_id").agg(F.count("*").alias("critical_count"))
            changed = {
                ALERTS: table_of(messages, [*before.files(ALERTS), *new_files(messages, path)]),
                COUNTS: merged_files(flat_window(added), path, before, COUNTS, WINDOW_KEYS, _hour("window_start"), add_counts),
                LATE: table_of(late, [*before.files(LATE), *(new_files(late, path) if n_late else [])]),
            }
            notes = {
                "batch": batch_id,
                "watermark_ms": max(mark, reached or 0),
                "late": before.notes.get("late", 0) + n_late,
            }
            commit(spark, path, before, changed, notes)
        finally:
            batch.unpersist()
        expire_versions(spark, path)

    writer = readings.writeStream.option("checkpointLocation", checkpoint).foreachBatch(on_batch)
    return (writer.trigger(**trigger) if trigger else writer).start()


def read_output(spark: SparkSession, path: str, output: str) -> DataFrame:
    """One of the outputs ALERTS, COUNTS and LATE of `start_alerts_and_counts`, as of its last whole batch."""
    return read_stored(spark, path, output)
