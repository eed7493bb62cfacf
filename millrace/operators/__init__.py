from millrace.operators.aggregates import (
    count_by,
    distinct_services,
    error_lines,
    group_topn,
    key_distribution,
    summarise,
    top_error_services,
    total_count,
)
from millrace.operators.joins import dim_join, in_other, join_count, sample_join_count, self_join_count
from millrace.operators.mutation import increment_first
from millrace.operators.placement import cache_table, repartition_by_key, repartition_evenly
from millrace.operators.ranking import first_k_per_key, latest_versions, limit_rows, preview, rank_limit, top_k
from millrace.operators.rows import (
    build_alerts,
    detect_anomalies,
    flag_reasons,
    numbered,
    process_alerts,
    sample_rows,
    size_gate,
)
from millrace.operators.runs import consecutive_breaches
from millrace.operators.subqueries import above_average, above_group_average

__all__ = [
    "above_average",
    "above_group_average",
    "build_alerts",
    "cache_table",
    "consecutive_breaches",
    "count_by",
    "detect_anomalies",
    "dim_join",
    "distinct_services",
    "error_lines",
    "first_k_per_key",
    "flag_reasons",
    "group_topn",
    "in_other",
    "increment_first",
    "join_count",
    "key_distribution",
    "latest_versions",
    "limit_rows",
    "numbered",
    "preview",
    "process_alerts",
    "rank_limit",
    "repartition_by_key",
    "repartition_evenly",
    "sample_join_count",
    "sample_rows",
    "self_join_count",
    "size_gate",
    "summarise",
    "top_error_services",
    "top_k",
    "total_count",
]
