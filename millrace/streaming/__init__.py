from millrace.streaming.alerts import alert_messages, parse_readings, parse_transactions, read_output, start_alerts_and_counts
from millrace.streaming.breaches import read_breaches, start_breach_stream
from millrace.streaming.metrics import anomaly_counts, running_metrics
from millrace.streaming.serving import hand_over, partial_aggregate, read_view, serving_view, start_speed_layer
from millrace.streaming.windows import critical_window_counts, flat_window

__all__ = [
    "alert_messages",
    "anomaly_counts",
    "critical_window_counts",
    "flat_window",
    "hand_over",
    "parse_readings",
    "parse_transactions",
    "partial_aggregate",
    "read_breaches",
    "read_output",
    "read_view",
    "running_metrics",
    "serving_view",
    "start_alerts_and_counts",
    "start_breach_stream",
    "start_speed_layer",
]
