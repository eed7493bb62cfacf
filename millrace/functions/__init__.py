from millrace.functions.hashing import bucket_of, in_sample
from millrace.functions.rules import (
    Rule,
    alert_condition,
    alert_text,
    any_fired,
    fired_reasons,
    over_limits,
    sensor_rules,
)

__all__ = [
    "Rule",
    "alert_condition",
    "alert_text",
    "any_fired",
    "bucket_of",
    "fired_reasons",
    "in_sample",
    "over_limits",
    "sensor_rules",
]
