from millrace.sinks.stored import (
    ConcurrentChange,
    append_rows,
    expire_versions,
    increment_stored,
    read_stored,
    replace_rows,
    stored_version,
    upsert_rows,
    write_upserts,
)
from millrace.sinks.streams import (
    finished_batches,
    latest_updates,
    read_snapshot,
    to_messages,
    write_files,
    write_snapshot,
    write_topic,
    write_update_log,
    write_updates,
)
from millrace.sinks.tables import (
    append_table,
    bucket_count,
    register_external,
    replace_table,
    write_bucketed,
    write_csv_report,
    write_partitioned,
)

__all__ = [
    "ConcurrentChange",
    "append_rows",
    "append_table",
    "bucket_count",
    "expire_versions",
    "finished_batches",
    "increment_stored",
    "latest_updates",
    "read_snapshot",
    "read_stored",
    "register_external",
    "replace_rows",
    "replace_table",
    "stored_version",
    "to_messages",
    "upsert_rows",
    "write_bucketed",
    "write_csv_report",
    "write_files",
    "write_partitioned",
    "write_snapshot",
    "write_topic",
    "write_update_log",
    "write_updates",
    "write_upserts",
]
