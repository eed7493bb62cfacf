"""The same queries as SQL over the given tables, for an independent engine to check."""

from __future__ import annotations

import re

from millrace.functions.hashing import NULL_TEXT, SAMPLE_DIGITS, sample_cut

MASK = 4294967295


def _murmur3(source: str, keep: list[str], inputs: list[tuple[str, str]]) -> str:
    """SELECT of `keep` plus `h`, Spark's hash() of `inputs` given as (SQL expression, "int" or "long").

    Murmur3 x86 32-bit, seed 42, worked out step by step in unsigned 64-bit arithmetic.
    """
    kept = ", ".join(keep)
    sql = f"SELECT {kept}, {{words}}, CAST(42 AS UBIGINT) AS h FROM {source}"
    steps: list[tuple[str, str, int]] = []
    words: list[str] = []
    for at, (expression, kind) in enumerate(inputs):
        value = f"(CAST({expression} AS HUGEINT) + 18446744073709551616) % 18446744073709551616"
        parts = [("lo", f"CAST(({value}) % 4294967296 AS UBIGINT)")]
        if kind == "long":
            parts.append(("hi", f"CAST(({value}) // 4294967296 AS UBIGINT)"))
        words += [f"{text} AS {name}{at}" for name, text in parts]
        steps += [("word", f"{name}{at}", 0) for name, _ in parts]
        steps.append(("end", f"lo{at}", 4 * len(parts)))
    sql = sql.replace("{words}", ", ".join(words))
    names = ", ".join([kept, *(w.rsplit(" AS ", 1)[1] for w in words)])

    def step(inner: str, **columns: str) -> str:
        """Recompute columns; `p`, the hash before the current input, is carried along."""
        new = ", ".join(f"{text} AS {name}" for name, text in {"p": "p", **columns}.items())
        return f"SELECT {names}, {new} FROM ({inner})"

    def rotl(x: str, r: int) -> str:
        return f"((({x} * {1 << r}) & {MASK}) | ({x} // {1 << (32 - r)}))"

    sql = f"SELECT *, h AS p FROM ({sql})"
    for kind, word, length in steps:
        if kind == "word":
            sql = step(sql, h="h", k=f"({word} * 3432918353) & {MASK}")
            sql = step(sql, h="h", k=f"({rotl('k', 15)} * 461845907) & {MASK}")
            sql = step(sql, h="xor(h, k)")
            sql = step(sql, h=f"({rotl('h', 13)} * 5 + 3864292196) & {MASK}")
        else:
            sql = step(sql, h=f"xor(h, CAST({length} AS UBIGINT))")
            sql = step(sql, h="xor(h, h // 65536)")
            sql = step(sql, h=f"(h * 2246822507) & {MASK}")
            sql = step(sql, h="xor(h, h // 8192)")
            sql = step(sql, h=f"(h * 3266489909) & {MASK}")
            sql = step(sql, h="xor(h, h // 65536)")
            # A NULL leaves the hash as it was.
            sql = step(sql, h=f"CASE WHEN {word} IS NULL THEN p ELSE h END")
            sql = step(sql, p="h", h="h")
    signed = "CASE WHEN h >= 2147483648 THEN CAST(h AS BIGINT) - 4294967296 ELSE CAST(h AS BIGINT) END"
    return f"SELECT {kept}, {signed} AS h FROM ({sql})"


def _half_up(sql: str) -> str:
    """Round averages half-up on their decimal digits, as Spark does, not on the binary value."""
    digits = r"CAST(ROUND(CAST(CAST(AVG(\1) AS VARCHAR) AS DECIMAL(38, 15)), 2) AS DOUBLE)"
    return re.sub(r"ROUND\(AVG\((\w+)\), 2\)", digits, sql)


def _pmod(n: int) -> str:
    return f"(((h % {n}) + {n}) % {n})"


def _sample(fraction: float, seed: int, columns: list[str]) -> str:
    digest = f"substr(md5('{seed}|' || coalesce(CAST(event_id AS VARCHAR), '{NULL_TEXT}')), 1, {SAMPLE_DIGITS})"
    return f"SELECT {', '.join(columns)} FROM events WHERE {digest} < '{sample_cut(fraction)}'"


READINGS = """(
    SELECT event_id, ts, CAST(user_id AS VARCHAR) AS sensor_id, value AS temperature,
           CAST(json_extract(props, '$.k') AS DOUBLE) AS humidity,
           CASE WHEN event_type = 'error' THEN 'critical' ELSE 'normal' END AS status
    FROM events)"""

ALERT_TEXT = "'ALERT: ' || sensor_id || ' - temp=' || CAST(temperature AS VARCHAR) || ' status=' || status"

ALERTS = f"""
    SELECT sensor_id, temperature, status, {ALERT_TEXT} AS alert_msg
    FROM {READINGS} WHERE temperature > 30 OR status = 'critical'"""

MESSAGES = f"""
    SELECT sensor_id AS key,
           '{{' || concat_ws(',', '"sensor_id":"' || sensor_id || '"',
                             '"temperature":' || CAST(temperature AS VARCHAR),
                             '"status":"' || status || '"', '"alert_msg":"' || alert_msg || '"') || '}}' AS value
    FROM ({ALERTS})"""

WINDOWS = """
    SELECT time_bucket(INTERVAL '5 seconds', ts) AS window_start,
           time_bucket(INTERVAL '5 seconds', ts) + INTERVAL '5 seconds' AS window_end,
           CAST(user_id AS VARCHAR) AS sensor_id, COUNT(*) AS critical_count
    FROM events WHERE event_type = 'error' GROUP BY ALL"""

LATE_WINDOWS = """
    SELECT window_start, window_end, sensor_id, COUNT(*) AS critical_count
    FROM (
        SELECT time_bucket(INTERVAL '5 seconds', ts) AS window_start,
               time_bucket(INTERVAL '5 seconds', ts) + INTERVAL '5 seconds' AS window_end,
               CAST(user_id AS VARCHAR) AS sensor_id, ts >= '2024-01-12' AS late
        FROM events WHERE event_type = 'error' AND ts IS NOT NULL)
    WHERE {kept} GROUP BY ALL"""

ANOMALIES = f"""
    SELECT event_id, ts, sensor_id,
           concat_ws(', ',
               CASE WHEN temperature > 32 THEN 'High temp: ' || CAST(temperature AS VARCHAR) || '°C' END,
               CASE WHEN status = 'critical' THEN 'Critical status' END,
               CASE WHEN humidity > 75 THEN 'High humidity: ' || CAST(humidity AS VARCHAR) || '%' END) AS reasons
    FROM {READINGS}
    WHERE temperature > 32 OR status = 'critical' OR humidity > 75"""

ANOMALY_TOTALS = f"""
    SELECT COUNT(*) AS processed,
           COUNT(*) FILTER (WHERE temperature > 32 OR status = 'critical' OR humidity > 75) AS anomalies
    FROM {READINGS}"""

METRICS = """
    SELECT COUNT(*) AS sensor_count,
           (SELECT value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1) AS current_temp,
           COUNT(*) FILTER (WHERE event_type = 'purchase') AS txn_count,
           ROUND(SUM(value) FILTER (WHERE event_type = 'purchase'), 2) AS total_revenue
    FROM events"""

BREACHES = """
    WITH marked AS (
        SELECT *, value > 50 AS breach,
               SUM(CASE WHEN value > 50 THEN 0 ELSE 1 END)
                   OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island
        FROM events),
    placed AS (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, island ORDER BY ts, event_id) AS place
        FROM marked WHERE breach)
    SELECT user_id, ts, event_id, value FROM placed WHERE place = 3"""

SAMPLES = """(
    SELECT user_id AS pid, event_type AS name, value AS cpu_pct,
           CAST(json_extract(props, '$.k') AS DOUBLE) / 10 AS mem_pct, ts AS sampled_at, event_id,
           value > 50 OR CAST(json_extract(props, '$.k') AS DOUBLE) > 50 AS "over"
    FROM events)"""

LOG_ERRORS = """
    SELECT 'app-' || COALESCE(CAST(user_id AS VARCHAR), 'unknown') AS "Service", COUNT(*) AS "Occurrences"
    FROM events WHERE event_type = 'error' GROUP BY 1
    ORDER BY "Occurrences" DESC, "Service" LIMIT 5"""

INCREMENTED = """
    SELECT e.event_id, e.user_id,
           e.value + CASE WHEN f.first_id IS NOT NULL THEN COALESCE(u.n, 0) ELSE 0 END AS value{stamp}
    FROM events e
    LEFT JOIN (SELECT user_id, MIN(event_id) AS first_id FROM events GROUP BY user_id) f
        ON f.user_id = e.user_id AND f.first_id = e.event_id
    LEFT JOIN (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey) u ON u.o_custkey = e.user_id"""

STAMP = """,
           CASE WHEN f.first_id IS NOT NULL AND u.n IS NOT NULL
                THEN CAST(1704067200.0 AS DOUBLE) END AS "lastUpdate\""""

PRIORITY_COUNTS = 'SELECT o_orderpriority, COUNT(*) AS "count" FROM orders GROUP BY o_orderpriority'

LINE_ID = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate"
LINE_ORDER = LINE_ID.replace(",", " NULLS FIRST,") + " NULLS FIRST"

ORACLE: dict[str, str] = {
    "key_profile": """
        SELECT CAST(l_linenumber AS DOUBLE) AS line_number, COUNT(*) AS line_count,
               ROUND(AVG(l_extendedprice), 2) AS avg_price, ROUND(AVG(l_tax), 2) AS avg_tax,
               ROUND(AVG(l_quantity), 2) AS avg_quantity
        FROM lineitem GROUP BY l_linenumber ORDER BY line_number""",
    "view_counts": "SELECT l_shipdate, COUNT(*) AS n FROM lineitem WHERE l_quantity > 40 GROUP BY ALL HAVING n > 1",
    "key_revenue": """
        SELECT o_orderpriority, COUNT(*) AS order_count, ROUND(SUM(o_totalprice), 2) AS total_revenue,
               ROUND(AVG(o_totalprice), 2) AS avg_order
        FROM orders GROUP BY o_orderpriority ORDER BY total_revenue DESC""",
    "key_counts": PRIORITY_COUNTS,
    "cached_key_counts": PRIORITY_COUNTS,
    "placed_key_counts": 'SELECT o_custkey, COUNT(*) AS "count" FROM orders GROUP BY o_custkey',
    "keyed_join_counts": """
        SELECT c_custkey, COUNT(*) AS "count" FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_custkey""",
    "two_key_agg": """
        SELECT l_returnflag, l_linenumber, COUNT(*) AS cnt, ROUND(AVG(l_extendedprice), 2) AS avg_price,
               ROUND(SUM(l_extendedprice), 2) AS sum_price
        FROM lineitem GROUP BY l_returnflag, l_linenumber""",
    "one_key_agg": """
        SELECT l_returnflag, COUNT(*) AS cnt, ROUND(AVG(l_extendedprice), 2) AS avg_price
        FROM lineitem GROUP BY l_returnflag""",
    "total_count": "SELECT COUNT(*) AS line_count FROM lineitem",
    "nested_group_topn": """
        SELECT event_type AS type, CAST(json_extract(props, '$.k') AS INTEGER) AS k, COUNT(*) AS "count",
               ROUND(AVG(value), 2) AS avg_value, ROUND(SUM(value), 2) AS total_value
        FROM events GROUP BY 1, 2 ORDER BY "count" DESC, type NULLS FIRST, k NULLS FIRST LIMIT 20""",
    "key_distribution": f"""
        WITH placed AS (
            SELECT CAST({_pmod(16)} AS INTEGER) AS bucket
            FROM ({_murmur3("events", ["user_id"], [("user_id", "long")])}))
        SELECT bucket, COUNT(*) AS row_count, COUNT(*) * 100.0 / (SELECT COUNT(*) FROM placed)::DOUBLE AS pct
        FROM placed GROUP BY bucket""",
    "harmonised_union_profile": """
        SELECT CAST(l_linenumber AS DOUBLE) AS l_linenumber, COUNT(*) AS line_count,
               ROUND(AVG(l_extendedprice), 2) AS avg_price, ROUND(AVG(l_quantity), 2) AS avg_quantity
        FROM lineitem GROUP BY 1 ORDER BY 1""",
    "select_filter": """
        SELECT o_orderkey, o_orderdate, o_totalprice AS total_price FROM orders WHERE o_totalprice > 300000""",
    "top_k_filtered": f"""
        SELECT l_extendedprice, {LINE_ID} FROM lineitem WHERE l_extendedprice > 50
        ORDER BY l_extendedprice DESC NULLS LAST, {LINE_ORDER} LIMIT 1000""",
    "alerts_or_filter": """
        SELECT event_id, user_id, event_type, value FROM events WHERE value > 30 OR event_type = 'error'""",
    "filter_limit": f"""
        SELECT {LINE_ID}, l_extendedprice FROM lineitem WHERE l_extendedprice > 50
        ORDER BY {LINE_ORDER}, l_extendedprice LIMIT 10000""",
    "filter_limit_any": """
        SELECT LEAST(COUNT(*), 10000) AS line_count, CASE WHEN COUNT(*) > 0 THEN true END AS all_above
        FROM lineitem WHERE l_extendedprice > 50""",
    "preview_rows": "SELECT * FROM events ORDER BY event_id LIMIT 10",
    "sample_rows": _sample(0.02, 7, ["event_id", "user_id", "value"]),
    "size_gate": """
        SELECT COUNT(*) FILTER (WHERE n_chars <= 5000) AS kept_count,
               CAST(SUM(n_chars) FILTER (WHERE n_chars <= 5000) AS BIGINT) AS kept_total,
               COUNT(*) FILTER (WHERE (n_chars <= 5000) IS NOT TRUE) AS skipped_count,
               CAST(SUM(n_chars) FILTER (WHERE (n_chars <= 5000) IS NOT TRUE) AS BIGINT) AS skipped_total
        FROM documents""",
    "size_gate_skipped": "SELECT doc_id, n_chars FROM documents WHERE (n_chars <= 5000) IS NOT TRUE",
    "size_gate_kept": "SELECT doc_id, n_chars FROM documents WHERE n_chars <= 5000",
    "sample_join_count": f"""
        SELECT CAST(COUNT(*) AS VARCHAR) AS join_rows
        FROM ({_sample(0.02, 1, ["event_type", "event_id"])}) a
        JOIN ({_sample(0.02, 2, ["event_type", "event_id"])}) b ON a.event_type = b.event_type""",
    "self_join_count": f"""
        WITH sampled AS ({_sample(0.01, 3, ["event_type", "event_id"])})
        SELECT CAST(COUNT(*) AS VARCHAR) AS join_rows
        FROM sampled a JOIN sampled b ON a.event_type = b.event_type""",
    "factorised_join_count": """
        SELECT CAST(COUNT(*) AS VARCHAR) AS join_rows
        FROM orders JOIN events ON o_custkey = user_id""",
    "dim_join": """
        SELECT c_custkey, c_name, c_nationkey AS nationkey, n_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "scalar_subquery": """
        SELECT o_orderkey, o_totalprice FROM orders
        WHERE o_totalprice > (SELECT AVG(o_totalprice) FROM orders)""",
    "in_subquery": """
        SELECT o_custkey AS c_custkey, o_orderkey FROM orders
        WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)""",
    "correlated_subquery": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_quantity FROM lineitem l
        WHERE l_quantity > (SELECT AVG(l_quantity) FROM lineitem i WHERE i.l_partkey = l.l_partkey)""",
    "first_k_per_key": """
        SELECT user_id, event_id, event_type, value FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM events)
        WHERE place <= 10 AND user_id IN (SELECT o_custkey FROM orders)""",
    "latest_versions": """
        SELECT user_id, ts, event_id, value FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place FROM events)
        WHERE place <= 3""",
    "consecutive_breaches": BREACHES,
    "consecutive_breaches_stream": BREACHES,
    "increment_first": INCREMENTED.format(stamp=""),
    "increment_first_set": INCREMENTED.format(stamp=STAMP),
    "log_error_top5": LOG_ERRORS,
    "log_error_report": LOG_ERRORS,
    "log_error_services": """
        SELECT DISTINCT 'app-' || COALESCE(CAST(user_id AS VARCHAR), 'unknown') AS service
        FROM events WHERE event_type = 'error'""",
    "log_files_top5": LOG_ERRORS.replace("GROUP BY 1", "AND event_id % 5 <> 0 GROUP BY 1"),
    "log_rejects": """
        WITH e AS (SELECT * REPLACE (COALESCE(event_type, 'unknown') AS event_type) FROM events),
        lines AS (
            SELECT event_id, strftime(ts, '%b %d %H:%M:%S') AS logged, '-' || COALESCE(CAST(user_id AS VARCHAR), 'unknown')
                   || '[' || event_id || ']' AS service, upper(event_type[1]) || event_type[2:] || ' with value '
                   || COALESCE(CAST(value AS VARCHAR), 'unknown') AS message
            FROM e)
        SELECT logged || ' node1 app' || service || ' - ' || message AS value FROM lines WHERE event_id % 5 = 0
        UNION ALL
        SELECT logged || ' no' || chr(1) || 'de1 app' || service || ': ' || message FROM lines WHERE event_id % 50 = 2
        UNION ALL
        SELECT 'error' || chr(1) || 'b' || chr(1) || 'c' || chr(1) || event_id FROM lines WHERE event_id % 50 = 1""",
    "log_times": """
        SELECT date_trunc('second', ts) + INTERVAL 1 YEAR * (2024 - year(ts)) AS logged_at, COUNT(*) AS n
        FROM events GROUP BY 1""",
    "json_decode": f"""
        SELECT event_id, sensor_id, temperature, humidity, status, ts AS event_time FROM {READINGS}""",
    "json_nested_decode": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "json_rejects": """
        SELECT event_id, CASE event_type WHEN 'view' THEN rtrim(props, '}') WHEN 'click' THEN '' WHEN 'purchase' THEN '  '
               WHEN 'error' THEN props || ' x' ELSE props END AS value
        FROM events WHERE event_type IN ('view', 'click', 'purchase', 'error') OR props IS NULL""",
    "anomaly_reasons": f"SELECT event_id, sensor_id, reasons FROM ({ANOMALIES})",
    "anomaly_stream": f"SELECT event_id, sensor_id, reasons FROM ({ANOMALIES})",
    "anomaly_numbers": f"""
        SELECT event_id, ROW_NUMBER() OVER (ORDER BY ts, event_id) AS anomaly_no FROM ({ANOMALIES})""",
    "process_alerts": f"""
        SELECT pid, name, cpu_pct, mem_pct, sampled_at FROM {SAMPLES} WHERE "over\"""",
    "process_breaches": f"""
        WITH marked AS (
            SELECT *, SUM(CASE WHEN "over" THEN 0 ELSE 1 END)
                OVER (PARTITION BY pid ORDER BY sampled_at, event_id ROWS UNBOUNDED PRECEDING) AS island
            FROM {SAMPLES}),
        placed AS (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY pid, island ORDER BY sampled_at, event_id) AS place
            FROM marked WHERE "over")
        SELECT pid, name, cpu_pct, mem_pct, sampled_at FROM placed WHERE place = 3""",
    "alert_rows": ALERTS,
    "alert_messages_batch": MESSAGES,
    "alert_stream": MESSAGES,
    "keyed_messages": """
        SELECT CAST(o_orderkey AS VARCHAR) AS key,
               '{' || concat_ws(',', '"o_custkey":' || o_custkey, '"o_orderstatus":"' || o_orderstatus || '"',
                                '"o_totalprice":' || CAST(o_totalprice AS VARCHAR)) || '}' AS value
        FROM orders""",
    "critical_counts": WINDOWS,
    "critical_window_counts_stream": WINDOWS,
    "critical_window_updates_stream": WINDOWS,
    "late_window_counts_critical": LATE_WINDOWS.format(kept="true"),
    "late_window_counts_all": LATE_WINDOWS.format(kept="""
        late IS NOT TRUE OR window_end > (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL '5 seconds' FROM events
            WHERE ts >= '2024-01-18' AND event_type <> 'error')"""),
    "alerts_and_counts_stream": f"""
        SELECT 'alerts' AS output, key AS sensor_id, value AS entry, COUNT(*) AS n FROM ({MESSAGES}) GROUP BY key, value
        UNION ALL
        SELECT 'counts', sensor_id, strftime(window_start, '%Y-%m-%d %H:%M:%S'), critical_count
        FROM ({WINDOWS}) WHERE window_start IS NOT NULL""",
    "late_readings_kept": """
        WITH critical AS (
            SELECT event_id, CAST(user_id AS VARCHAR) AS sensor_id, ts >= '2024-01-12' AND ts < '2024-01-18'
                   AND time_bucket(INTERVAL '5 seconds', ts) + INTERVAL '5 seconds'
                       <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL '5 seconds' FROM events
                           WHERE event_type = 'error' AND (ts < '2024-01-12' OR ts >= '2024-01-18')) AS late
            FROM events WHERE event_type = 'error' AND ts IS NOT NULL)
        SELECT 'late' AS output, sensor_id, event_id, 1 AS n FROM critical WHERE late
        UNION ALL
        SELECT 'counted', sensor_id, NULL, COUNT(*) FROM critical WHERE NOT late GROUP BY sensor_id""",
    "anomaly_totals": ANOMALY_TOTALS,
    "anomaly_counts_stream": ANOMALY_TOTALS,
    "running_metrics_batch": METRICS,
    "running_metrics_stream": METRICS,
    "lambda_serving_view": """
        SELECT event_type, COUNT(*) AS "count", ROUND(SUM(value), 2) AS total, ROUND(AVG(value), 2) AS average
        FROM events GROUP BY event_type""",
    "partitioned_roundtrip": """
        SELECT *, CASE WHEN o_orderkey % 5 > 0 THEN strftime(o_orderdate, '%m') END AS o_month FROM orders""",
    "partition_overwrite": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 0.0 ELSE o_totalprice END AS o_totalprice,
               o_orderstatus FROM orders""",
    "bucketed_roundtrip": """
        SELECT l_orderkey, COUNT(*) AS line_count, SUM(l_quantity) AS quantity FROM lineitem GROUP BY l_orderkey""",
    "bucketed_join": """
        SELECT o_orderstatus, COUNT(*) AS line_count, SUM(l_quantity) AS quantity
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY o_orderstatus""",
    "stored_roundtrip": "SELECT * FROM events",
    "increment_stored_rows": INCREMENTED.format(stamp=""),
    "variant_field_kinds": """
        SELECT unnest(['_id', 'userId', 'eventType', 'value', 'value', 'note', 'metadata']) AS field,
               unnest(['NUMBER', 'NUMBER', 'STRING', 'NUMBER', 'STRING', 'STRING', 'OBJECT']) AS kind,
               unnest([COUNT(*), COUNT(user_id), COUNT(event_type), COUNT(value) FILTER (event_id % 4 > 0),
                       COUNT(value) FILTER (event_id % 4 = 0), COUNT(*) FILTER (event_id % 3 = 0), COUNT(props)]) AS n
        FROM events""",
    "variant_documents": """
        SELECT event_id AS _id, CASE WHEN event_id % 4 > 0 THEN value END AS value,
               CASE WHEN event_id % 4 = 0 THEN 'about ' || CAST(value AS VARCHAR) END AS about,
               CASE WHEN event_id % 3 = 0 THEN 'note ' || event_id END AS note,
               CAST(json_extract(props, '$.k') AS INTEGER) AS k
        FROM events""",
    "external_roundtrip": "SELECT * FROM customer",
    "append_replace_roundtrip": "SELECT * FROM events",
    "documents_roundtrip": """
        SELECT event_id AS _id, CAST(user_id AS INTEGER) AS "userId", event_type AS "eventType", value,
               CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
    "drifting_files_profile": """
        SELECT CAST(l_linenumber AS DOUBLE) AS l_linenumber, COUNT(*) AS line_count,
               ROUND(AVG(l_extendedprice), 2) AS avg_price, ROUND(AVG(l_quantity), 2) AS avg_quantity
        FROM lineitem GROUP BY 1 ORDER BY 1""",
    "csv_header_roundtrip": "SELECT * FROM customer",
    "csv_rejects": """
        SELECT c_custkey || ',' || COALESCE(c_name, '') || CASE c_custkey % 7 WHEN 0 THEN ',7,much,s' WHEN 1 THEN ',7,1.5'
               ELSE ',7,1.5,s,t' END AS line
        FROM customer WHERE c_custkey % 7 < 3""",
    "csv_roundtrip": "SELECT * FROM customer",
}

ORACLE = {name: _half_up(sql) for name, sql in ORACLE.items()}
