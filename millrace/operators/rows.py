"""Row-wise operators: rules, gates and samples. None of them shuffles, except `numbered`."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions import (
    Rule,
    alert_condition,
    alert_text,
    any_fired,
    fired_reasons,
    in_sample,
    over_limits,
    sensor_rules,
)
from millrace.functions.rules import (
    ALERT_TEMPERATURE,
    ANOMALY_HUMIDITY,
    ANOMALY_TEMPERATURE,
    PROCESS_CPU_PCT,
    PROCESS_MEMORY_MB,
)
from millrace.session import materialise


def sample_rows(df: DataFrame, fraction: float, seed: int, by: list[str] | None = None) -> DataFrame:
    """Random sample without replacement.

    With `by`, the columns that identify a row, the sample depends on the data and the seed alone; without
    it also on how the input is split.
    """
    return df.filter(in_sample(fraction, seed, *by)) if by else df.sample(fraction=fraction, seed=seed)


def flag_reasons(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows for which at least one rule holds, with the array of the `reasons` of all that do."""
    return df.filter(any_fired(rules)).withColumn("reasons", fired_reasons(rules))


def detect_anomalies(
    df: DataFrame, temperature: float = ANOMALY_TEMPERATURE, humidity: float = ANOMALY_HUMIDITY
) -> DataFrame:
    """Readings that break at least one sensor rule, with their reasons joined into one text."""
    flagged = flag_reasons(df, sensor_rules(temperature, humidity))
    return flagged.withColumn("reasons", F.array_join("reasons", ", "))


def numbered(df: DataFrame, order: list[Column | str], name: str = "anomaly_no") -> DataFrame:
    """Running number of each row in `order`, computed without sorting everything in one task.

    Rows are range-partitioned by `order` and sorted within each range, the only shuffle; they are numbered
    where they are, and the sizes of the ranges before it, one row per task, give the offset.
    """
    # The id is the range in the upper bits and the place within it in the lower 33. The bounds come from a
    # sample, so the ranges are fixed once before they are read twice.
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = materialise(ranged.withColumn("_id", F.monotonically_increasing_id()))
    at = F.shiftright("_id", 33)
    sizes = ranged.groupBy(at.alias("_range")).agg(F.count("*").alias("_size"))
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    local = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return (
        ranged.withColumn("_range", at)
        .join(F.broadcast(offsets), "_range")
        .withColumn(name, local + F.col("_offset"))
        .drop("_range", "_id", "_offset")
    )


def build_alerts(df: DataFrame, temperature: float = ALERT_TEMPERATURE) -> DataFrame:
    """Hot or critical readings with their alert text."""
    alerts = df.filter(alert_condition(temperature)).select("sensor_id", "temperature", "status")
    return alerts.withColumn("alert_msg", alert_text())


def process_alerts(
    samples: DataFrame, cpu_pct: float = PROCESS_CPU_PCT, memory_mb: float = PROCESS_MEMORY_MB
) -> DataFrame:
    """Process samples over a limit."""
    return samples.filter(over_limits(cpu_pct, memory_mb)).select("pid", "name", "cpu_pct", "mem_pct", "sampled_at")


class Gated(NamedTuple):
    """Rows within the limit, rows over it, and one row with counts and totals of both."""

    kept: DataFrame
    skipped: DataFrame
    totals: DataFrame


def size_gate(df: DataFrame, size_col: str, limit: int) -> Gated:
    """Split rows by size; a row of unknown size is skipped, so kept and skipped make up the input."""
    within = F.coalesce(F.col(size_col) <= limit, F.lit(False))
    size = F.col(size_col)
    totals = df.agg(
        F.count_if(within).alias("kept_count"),
        F.coalesce(F.sum(F.when(within, size)), F.lit(0)).alias("kept_total"),
        F.count_if(~within).alias("skipped_count"),
        F.coalesce(F.sum(F.when(~within, size)), F.lit(0)).alias("skipped_total"),
    )
    return Gated(df.filter(within), df.filter(~within), totals)
