from millrace.sources.logs import log_fields, log_time, read_logs, rejected_lines
from millrace.sources.messages import decode_json, expanded, rejected_json
from millrace.sources.schemas import (
    CARD_TRANSACTION,
    DEPARTMENT,
    EVENT_DOCUMENT,
    SENSOR_READING,
    STUDENT,
    TRANSACTION,
)
from millrace.sources.tables import (
    harmonise_union,
    read_csv,
    read_documents,
    read_drifting,
    read_table,
    register_view,
    rejected_csv,
    rejected_documents,
)
from millrace.sources.topics import read_topic, stream_table
from millrace.sources.variants import field_kinds, found_schema, read_variants, typed_fields

__all__ = [
    "CARD_TRANSACTION",
    "DEPARTMENT",
    "EVENT_DOCUMENT",
    "SENSOR_READING",
    "STUDENT",
    "TRANSACTION",
    "decode_json",
    "expanded",
    "field_kinds",
    "found_schema",
    "harmonise_union",
    "log_fields",
    "log_time",
    "read_csv",
    "read_documents",
    "read_drifting",
    "read_logs",
    "read_table",
    "read_topic",
    "read_variants",
    "register_view",
    "rejected_csv",
    "rejected_documents",
    "rejected_json",
    "rejected_lines",
    "stream_table",
    "typed_fields",
]
