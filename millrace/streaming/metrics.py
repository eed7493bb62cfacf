"""Running totals: one state row, to which each task contributes one partial row per batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import any_fired, sensor_rules
from millrace.functions.rules import ANOMALY_HUMIDITY, ANOMALY_TEMPERATURE


def anomaly_counts(
    readings: DataFrame, temperature: float = ANOMALY_TEMPERATURE, humidity: float = ANOMALY_HUMIDITY
) -> DataFrame:
    """Readings processed and anomalies among them so far."""
    anomalous = any_fired(sensor_rules(temperature, humidity))
    return readings.agg(F.count("*").alias("processed"), F.count_if(anomalous).alias("anomalies"))


def running_metrics(sensors: DataFrame, transactions: DataFrame, tie: str = "sensor_id") -> DataFrame:
    """Sensor readings, current temperature, transactions and total revenue so far, as one row.

    A missing temperature or amount counts as 0. The current temperature is that of the latest
    `event_time`, then the largest `tie`, so that it does not depend on which task finishes last.
    """
    both = sensors.select(
        F.lit("sensor").alias("topic"),
        F.coalesce("temperature", F.lit(0.0)).alias("temperature"),
        F.struct("event_time", tie).alias("recency"),
    ).unionByName(
        transactions.select(
            F.lit("transaction").alias("topic"), F.coalesce("amount", F.lit(0.0)).alias("amount")
        ),
        allowMissingColumns=True,
    )
    return both.agg(
        F.count_if(F.col("topic") == "sensor").alias("sensor_count"),
        F.coalesce(F.max_by("temperature", "recency"), F.lit(0.0)).alias("current_temp"),
        F.count_if(F.col("topic") == "transaction").alias("txn_count"),
        F.coalesce(F.sum("amount"), F.lit(0.0)).alias("total_revenue"),
    )
