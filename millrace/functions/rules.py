"""Alert and anomaly rules as column expressions.

The stream alert (temperature 30) and the anomaly rules (temperature 32, humidity 75) are two different
rules; all comparisons are strict.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


# The texts of reasons and alerts, and the thresholds that apply unless others are given.
HIGH_TEMPERATURE = ("High temp: ", "°C")
CRITICAL = "Critical status"
HIGH_HUMIDITY = ("High humidity: ", "%")
ALERT = ("ALERT: ", " - temp=", " status=")
ANOMALY_TEMPERATURE = 32.0
ANOMALY_HUMIDITY = 75.0
ALERT_TEMPERATURE = 30.0
PROCESS_CPU_PCT = 5.0
PROCESS_MEMORY_MB = 50.0


class Rule(NamedTuple):
    """A condition and the text it adds when it holds; a NULL condition does not hold."""

    condition: Column
    reason: Column


def _measure(name: str, before_and_after: tuple[str, str]) -> Column:
    before, after = map(F.lit, before_and_after)
    return F.concat(before, F.col(name).cast("string"), after)


def sensor_rules(
    temperature: float = ANOMALY_TEMPERATURE, humidity: float = ANOMALY_HUMIDITY
) -> list[Rule]:
    """Rules for sensor readings, in the order their reasons are listed."""
    return [
        Rule(F.col("temperature") > temperature, _measure("temperature", HIGH_TEMPERATURE)),
        Rule(F.col("status") == "critical", F.lit(CRITICAL)),
        Rule(F.col("humidity") > humidity, _measure("humidity", HIGH_HUMIDITY)),
    ]


def any_fired(rules: list[Rule]) -> Column:
    """Whether at least one rule holds; never NULL."""
    return reduce(Column.__or__, (F.coalesce(rule.condition, F.lit(False)) for rule in rules))


def fired_reasons(rules: list[Rule]) -> Column:
    """Array of the reasons of all rules that hold."""
    return F.array_compact(F.array(*(F.when(rule.condition, rule.reason) for rule in rules)))


def alert_condition(temperature: float = ALERT_TEMPERATURE) -> Column:
    """Hot or critical. By three-valued logic a critical row without a temperature passes."""
    return (F.col("temperature") > temperature) | (F.col("status") == "critical")


def alert_text() -> Column:
    """Message text of an alert; NULL if any part of it is NULL."""
    parts = zip(ALERT, ("sensor_id", "temperature", "status"), strict=True)
    return F.concat(*(c for text, name in parts for c in (F.lit(text), F.col(name).cast("string"))))


def over_limits(cpu_pct: float = PROCESS_CPU_PCT, memory_mb: float = PROCESS_MEMORY_MB) -> Column:
    """Whether a process sample is over the CPU or the memory limit."""
    return (F.col("cpu_pct") > cpu_pct) | (F.col("mem_mb") > memory_mb)
