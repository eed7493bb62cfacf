"""Registered batch queries. Each takes (spark, sf_dir), reads whole tables and returns a frame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import operators as op
from millrace.functions import over_limits
from millrace.plans import roles
from millrace.plans.roles import table, tables
from millrace.session import materialise, scratch_path
from millrace.sinks import (
    append_rows,
    append_table,
    bucket_count,
    increment_stored,
    read_stored,
    register_external,
    replace_rows,
    replace_table,
    to_messages,
    write_bucketed,
    write_csv_report,
    write_partitioned,
)
from millrace.sources import (
    decode_json,
    field_kinds,
    harmonise_union,
    log_fields,
    log_time,
    read_csv,
    read_documents,
    read_drifting,
    read_logs,
    read_table,
    read_variants,
    register_view,
    rejected_csv,
    rejected_json,
    rejected_lines,
    typed_fields,
)
from millrace.streaming import (
    alert_messages,
    anomaly_counts,
    critical_window_counts,
    flat_window,
    parse_readings,
    running_metrics,
)

Query = Callable[[SparkSession, str], DataFrame]
BATCH: dict[str, Query] = {}

LINE_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]


def query(run: Query) -> Query:
    BATCH[run.__name__] = run
    return run


# Grouping


@query
def key_profile(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("line_number", F.col("l_linenumber").cast("double"))
    return op.summarise(
        lines,
        ["line_number"],
        count="line_count",
        averages={"l_extendedprice": "avg_price", "l_tax": "avg_tax", "l_quantity": "avg_quantity"},
        places=2,
        order=["line_number"],
    )


@query
def view_counts(spark, sf_dir):
    register_view(table(spark, sf_dir, "lineitem"), "lines")
    return spark.sql("SELECT l_shipdate, count(*) AS n FROM lines WHERE l_quantity > 40 GROUP BY ALL HAVING n > 1")


@query
def key_revenue(spark, sf_dir):
    return op.summarise(
        table(spark, sf_dir, "orders"),
        ["o_orderpriority"],
        count="order_count",
        sums={"o_totalprice": "total_revenue"},
        averages={"o_totalprice": "avg_order"},
        places=2,
        order=[F.desc("total_revenue")],
    )


@query
def key_counts(spark, sf_dir):
    return op.count_by(table(spark, sf_dir, "orders"), "o_orderpriority")


@query
def two_key_agg(spark, sf_dir):
    return op.summarise(
        table(spark, sf_dir, "lineitem"),
        ["l_returnflag", "l_linenumber"],
        count="cnt",
        averages={"l_extendedprice": "avg_price"},
        sums={"l_extendedprice": "sum_price"},
        places=2,
    )


@query
def one_key_agg(spark, sf_dir):
    return op.summarise(
        table(spark, sf_dir, "lineitem"),
        ["l_returnflag"],
        count="cnt",
        averages={"l_extendedprice": "avg_price"},
        places=2,
    )


@query
def total_count(spark, sf_dir):
    return op.total_count(table(spark, sf_dir, "lineitem"), "line_count")


@query
def cached_key_counts(spark, sf_dir):
    cached, _ = op.cache_table(table(spark, sf_dir, "orders").select("o_orderpriority"))
    counts = materialise(op.count_by(cached, "o_orderpriority"))
    cached.unpersist()
    return counts


@query
def placed_key_counts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey")
    width = int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum"))
    return op.count_by(op.repartition_evenly(orders, width), "o_custkey")


@query
def keyed_join_counts(spark, sf_dir):
    """A join and a grouping that both use the placement by key chosen before them."""
    orders, customers = tables(spark, sf_dir, "orders", "customer")
    width = int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum"))
    placed = op.repartition_by_key(orders.select(F.col("o_custkey").alias("c_custkey")), width, "c_custkey")
    return op.count_by(placed.join(customers.select("c_custkey"), "c_custkey"), "c_custkey")


@query
def nested_group_topn(spark, sf_dir):
    documents = roles.documents(table(spark, sf_dir, "events"))
    top = op.group_topn(documents, {"type": "eventType", "k": "metadata.k"}, "value", 20)
    return top.withColumn("avg_value", F.round("avg_value", 2)).withColumn(
        "total_value", F.round("total_value", 2)
    )


@query
def key_distribution(spark, sf_dir):
    return op.key_distribution(table(spark, sf_dir, "events"), ["user_id"], 16)


# Filters, limits, samples


@query
def harmonised_union_profile(spark, sf_dir):
    frames = roles.drifting(table(spark, sf_dir, "lineitem"))
    return op.summarise(
        harmonise_union(frames, {"l_linenumber": "double"}),
        ["l_linenumber"],
        count="line_count",
        averages={"l_extendedprice": "avg_price", "l_quantity": "avg_quantity"},
        places=2,
        order=["l_linenumber"],
    )


@query
def select_filter(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    chosen = orders.select("o_orderkey", "o_orderdate", "o_totalprice").where(F.col("o_totalprice") > 300000)
    return chosen.withColumnRenamed("o_totalprice", "total_price")


@query
def top_k_filtered(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_extendedprice", *LINE_ID)
    order = [F.desc("l_extendedprice"), *LINE_ID]
    return op.top_k(lines.filter(F.col("l_extendedprice") > 50), order, 1000)


@query
def alerts_or_filter(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return events.filter((F.col("value") > 30) | (F.col("event_type") == "error"))


@query
def filter_limit(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*LINE_ID, "l_extendedprice")
    matching = lines.filter(F.col("l_extendedprice") > 50)
    return op.limit_rows(matching, 10000, [*LINE_ID, "l_extendedprice"])


@query
def filter_limit_any(spark, sf_dir):
    """Which rows come is open, so what they have in common is shown."""
    lines = table(spark, sf_dir, "lineitem").select(*LINE_ID, "l_extendedprice")
    some = op.limit_rows(lines.filter(F.col("l_extendedprice") > 50), 10000)
    return some.agg(F.count("*").alias("line_count"), F.every(F.col("l_extendedprice") > 50).alias("all_above"))


@query
def preview_rows(spark, sf_dir):
    return op.preview(table(spark, sf_dir, "events"), 10, ["event_id"])


@query
def sample_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return op.sample_rows(events, 0.02, seed=7, by=["event_id"])


@query
def size_gate(spark, sf_dir):
    return op.size_gate(table(spark, sf_dir, "documents"), "n_chars", 5000).totals


@query
def size_gate_skipped(spark, sf_dir):
    skipped = op.size_gate(table(spark, sf_dir, "documents"), "n_chars", 5000).skipped
    return skipped.select("doc_id", "n_chars")


@query
def size_gate_kept(spark, sf_dir):
    kept = op.size_gate(table(spark, sf_dir, "documents"), "n_chars", 5000).kept
    return kept.select("doc_id", "n_chars")


# Joins and nested queries. A join count can pass the BIGINT range, so it is shown as text.


@query
def sample_join_count(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    joined = op.sample_join_count(events, ["event_type"], 0.02, seeds=(1, 2), by=["event_id"])
    return joined.select(F.col("join_rows").cast("string").alias("join_rows"))


@query
def self_join_count(spark, sf_dir):
    sample = op.sample_rows(table(spark, sf_dir, "events"), 0.01, seed=3, by=["event_id"])
    joined = op.self_join_count(sample, ["event_type"])
    return joined.select(F.col("join_rows").cast("string").alias("join_rows"))


@query
def factorised_join_count(spark, sf_dir):
    orders, events = tables(spark, sf_dir, "orders", "events")
    joined = op.join_count(
        orders.select(F.col("o_custkey").alias("key")), events.select(F.col("user_id").alias("key")), ["key"]
    )
    return joined.select(F.col("join_rows").cast("string").alias("join_rows"))


@query
def dim_join(spark, sf_dir):
    customers, nations = tables(spark, sf_dir, "customer", "nation")
    joined = op.dim_join(
        customers.withColumnRenamed("c_nationkey", "nationkey"),
        nations.withColumnRenamed("n_nationkey", "nationkey"),
        "nationkey",
    )
    return joined.select("c_custkey", "c_name", "nationkey", "n_name")


@query
def scalar_subquery(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return op.above_average(orders, "o_totalprice")


@query
def in_subquery(spark, sf_dir):
    orders, customers = tables(spark, sf_dir, "orders", "customer")
    placed = orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return op.in_other(placed, customers.filter(F.col("c_acctbal") > 5000), "c_custkey")


@query
def correlated_subquery(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    return op.above_group_average(lines, "l_partkey", "l_quantity")


# Ranking, runs, keyed changes


@query
def first_k_per_key(spark, sf_dir):
    events, orders = tables(spark, sf_dir, "events", "orders")
    documents = events.select("user_id", "event_id", "event_type", "value")
    keys = orders.select(F.col("o_custkey").alias("user_id"))
    return op.first_k_per_key(documents, keys, "user_id", ["event_id"], 10)


@query
def latest_versions(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    return op.latest_versions(events, ["user_id"], [F.desc("ts"), F.desc("event_id")], 3)


@query
def consecutive_breaches(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    return op.consecutive_breaches(events, ["user_id"], ["ts", "event_id"], F.col("value") > 50)


def _increments(spark, sf_dir, stamp=None):
    """One update per order, to the first event of the user with the customer's number."""
    events, orders = tables(spark, sf_dir, "events", "orders")
    return op.increment_first(
        events.select("event_id", "user_id", "value"),
        orders.select(F.col("o_custkey").alias("user_id")),
        "user_id",
        ["event_id"],
        "value",
        stamp=stamp,
    )


@query
def increment_first(spark, sf_dir):
    return _increments(spark, sf_dir)


@query
def increment_first_set(spark, sf_dir):
    return _increments(spark, sf_dir, stamp=F.lit(1704067200.0))


# Logs, messages, rules


@query
def log_error_top5(spark, sf_dir):
    logs = log_fields(roles.log_text(table(spark, sf_dir, "events")), containing="error")
    return op.top_error_services(logs, 5)


@query
def log_error_services(spark, sf_dir):
    logs = log_fields(roles.log_text(table(spark, sf_dir, "events")), containing="error")
    return op.distinct_services(logs)


@query
def log_error_report(spark, sf_dir):
    logs = log_fields(roles.log_text(table(spark, sf_dir, "events")), containing="error")
    path = scratch_path(spark, "report")
    write_csv_report(op.top_error_services(logs, 5), path)
    return read_csv(spark, path, "Service STRING, Occurrences BIGINT")


def _log_folder(spark, sf_dir):
    """The log as text files; every fifth line has another layout, and some more hold the character that parts fields."""
    path = scratch_path(spark, "logs")
    events = table(spark, sf_dir, "events")
    shifted = F.replace("value", F.lit(" node1 "), F.lit(" no\x01de1 "))
    shifted = roles.log_text(events.filter(F.col("event_id") % 50 == 2)).select(shifted.alias("value"))
    junk = events.filter(F.col("event_id") % 50 == 1).select(F.format_string("error\x01b\x01c\x01%d", "event_id").alias("value"))
    roles.log_text(events, broken=5).union(shifted).union(junk).write.text(path)
    return path


@query
def log_files_top5(spark, sf_dir):
    return op.top_error_services(read_logs(spark, _log_folder(spark, sf_dir), containing="error"), 5)


@query
def log_rejects(spark, sf_dir):
    return rejected_lines(spark.read.text(_log_folder(spark, sf_dir)))


@query
def log_times(spark, sf_dir):
    logs = log_fields(roles.log_text(table(spark, sf_dir, "events")))
    return logs.groupBy(log_time(year=2024).cast("timestamp_ntz").alias("logged_at")).agg(F.count("*").alias("n"))


@query
def json_decode(spark, sf_dir):
    messages = roles.reading_messages(table(spark, sf_dir, "events"))
    parsed = parse_readings(messages, keep=("event_id",))
    return parsed.select(
        "event_id",
        "sensor_id",
        "temperature",
        "humidity",
        "status",
        F.col("event_time").cast("timestamp_ntz").alias("event_time"),
    )


@query
def json_nested_decode(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "props")
    return decode_json(events, roles.PROPS, ts_col=None, column="props", keep=("event_id",))


@query
def json_rejects(spark, sf_dir):
    # View events lose their closing brace, those of clicks are empty, of purchases blank, of errors too long.
    kind = F.col("event_type")
    cut = (
        F.when(kind == "view", F.rtrim(F.col("props"), F.lit("}")))
        .when(kind == "click", "")
        .when(kind == "purchase", "  ")
        .when(kind == "error", F.concat("props", F.lit(" x")))
        .otherwise(F.col("props"))
    )
    messages = table(spark, sf_dir, "events").select("event_id", cut.alias("value"))
    return rejected_json(messages, roles.PROPS)


@query
def anomaly_reasons(spark, sf_dir):
    anomalies = op.detect_anomalies(roles.readings(table(spark, sf_dir, "events"), filtered=True))
    return anomalies.select("event_id", "sensor_id", "reasons")


@query
def anomaly_numbers(spark, sf_dir):
    anomalies = op.detect_anomalies(roles.readings(table(spark, sf_dir, "events"), filtered=True))
    return op.numbered(anomalies.select("event_id", "event_time"), ["event_time", "event_id"]).select(
        "event_id", "anomaly_no"
    )


@query
def process_alerts(spark, sf_dir):
    return op.process_alerts(roles.process_samples(table(spark, sf_dir, "events")), cpu_pct=50.0)


@query
def process_breaches(spark, sf_dir):
    samples = roles.process_samples(table(spark, sf_dir, "events"))
    over = over_limits(cpu_pct=50.0, memory_mb=50.0)
    breaches = op.consecutive_breaches(samples, ["pid"], ["sampled_at", "event_id"], over, 3)
    return breaches.select("pid", "name", "cpu_pct", "mem_pct", "sampled_at")


@query
def alert_rows(spark, sf_dir):
    return op.build_alerts(roles.readings(table(spark, sf_dir, "events")))


@query
def alert_messages_batch(spark, sf_dir):
    return alert_messages(roles.readings(table(spark, sf_dir, "events")))


@query
def keyed_messages(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return to_messages(orders, "o_orderkey", ["o_custkey", "o_orderstatus", "o_totalprice"])


@query
def critical_counts(spark, sf_dir):
    return flat_window(critical_window_counts(roles.readings(table(spark, sf_dir, "events"))))


@query
def anomaly_totals(spark, sf_dir):
    return anomaly_counts(roles.readings(table(spark, sf_dir, "events")))


@query
def running_metrics_batch(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    metrics = running_metrics(roles.readings(events), roles.purchases(events), tie="event_id")
    return metrics.withColumn("total_revenue", F.round("total_revenue", 2))


# Table layouts: written to the shared folder and read back


@query
def partitioned_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "partitioned")
    orders = table(spark, sf_dir, "orders")
    # Text that looks like a number, and NULLs.
    day = F.when(F.col("o_orderkey") % 5 > 0, F.date_format("o_orderdate", "MM"))
    orders = orders.withColumn("o_month", day)
    write_partitioned(orders, path, ["o_month"])
    return read_table(spark, path, orders.schema)


@query
def partition_overwrite(spark, sf_dir):
    path = scratch_path(spark, "partitioned")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    write_partitioned(orders, path, ["o_orderstatus"])
    # Only the open orders are written again, at price 0; the other partitions stay.
    reopened = orders.filter(F.col("o_orderstatus") == "O").withColumn("o_totalprice", F.lit(0.0))
    write_partitioned(reopened, path, ["o_orderstatus"])
    return read_table(spark, path).select(*orders.columns)


@query
def bucketed_roundtrip(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    name = f"lines_{uuid.uuid4().hex}"
    bucketed = write_bucketed(lines, name, "l_orderkey", scratch_path(spark, "bucketed"))
    return op.summarise(bucketed, ["l_orderkey"], count="line_count", sums={"l_quantity": "quantity"})


@query
def bucketed_join(spark, sf_dir):
    """Lines of each order status, by a join of two bucketed tables of which one has twice the buckets."""
    orders, lines = tables(spark, sf_dir, "orders", "lineitem")
    names = [f"{name}_{uuid.uuid4().hex}" for name in ("orders", "lines")]
    orders = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    lines = lines.select("l_orderkey", "l_quantity")
    # A task of the join reads one bucket of orders and two of lines.
    n = max(bucket_count(orders), -(-bucket_count(lines) // 2))
    orders = write_bucketed(orders, names[0], "l_orderkey", scratch_path(spark, "bucketed"), n=n)
    lines = write_bucketed(lines, names[1], "l_orderkey", scratch_path(spark, "bucketed"), n=2 * n)
    joined = lines.join(orders.hint("merge"), "l_orderkey")
    return op.summarise(joined, ["o_orderstatus"], count="line_count", sums={"l_quantity": "quantity"})


@query
def external_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "external")
    replace_table(table(spark, sf_dir, "customer"), path)
    return register_external(spark, f"customers_{uuid.uuid4().hex}", path)


@query
def append_replace_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "collection")
    events = table(spark, sf_dir, "events")
    replace_table(events, path)
    is_error = F.col("event_type").eqNullSafe("error")
    replace_table(events.filter(is_error), path)
    append_table(events.filter(~is_error), path)
    return read_table(spark, path)


@query
def stored_roundtrip(spark, sf_dir):
    """Events stored, replaced by a part of themselves, and completed by a batch that comes twice."""
    path = scratch_path(spark, "store")
    events = table(spark, sf_dir, "events")
    replace_rows(events, path)
    is_error = F.col("event_type").eqNullSafe("error")
    replace_rows(read_stored(spark, path).filter(is_error), path)
    for _ in range(2):
        append_rows(events.filter(~is_error), path, batch=("rest", 1))
    return read_stored(spark, path)


@query
def increment_stored_rows(spark, sf_dir):
    """`increment_first` on a stored table, of which only files with a row to change are written."""
    path = scratch_path(spark, "store")
    events, orders = tables(spark, sf_dir, "events", "orders")
    replace_rows(events.select("event_id", "user_id", "value").repartitionByRange(8, "event_id"), path)
    increment_stored(spark, path, orders.select(F.col("o_custkey").alias("user_id")), "user_id", ["event_id"], "value")
    return read_stored(spark, path)


def _loose_documents(spark, sf_dir):
    path = scratch_path(spark, "documents")
    roles.loose_documents(table(spark, sf_dir, "events")).write.text(path)
    return read_variants(spark, path)


@query
def variant_field_kinds(spark, sf_dir):
    return field_kinds(_loose_documents(spark, sf_dir))


@query
def variant_documents(spark, sf_dir):
    fields = {"_id": "$._id BIGINT", "value": "$.value DOUBLE", "about": "$.value STRING", "note": "$.note STRING", "k": "$.metadata.k INT"}
    docs = typed_fields(_loose_documents(spark, sf_dir), fields)
    return docs.withColumn("about", F.when(F.col("about").startswith("about"), F.col("about")))


@query
def documents_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "documents")
    roles.documents(table(spark, sf_dir, "events")).write.json(path)
    loaded = read_documents(spark, path, roles.DOCUMENT)
    return loaded.select("_id", "userId", "eventType", "value", F.col("metadata.k").alias("k"))


@query
def drifting_files_profile(spark, sf_dir):
    paths = [scratch_path(spark, f"month{at}") for at in range(3)]
    for frame, path in zip(roles.drifting(table(spark, sf_dir, "lineitem")), paths, strict=True):
        frame.write.parquet(path)
    return op.summarise(
        read_drifting(spark, paths, {"l_linenumber": "double"}),
        ["l_linenumber"],
        count="line_count",
        averages={"l_extendedprice": "avg_price", "l_quantity": "avg_quantity"},
        places=2,
        order=["l_linenumber"],
    )


CUSTOMER = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


@query
def csv_header_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    table(spark, sf_dir, "customer").write.csv(path, header=True)
    return read_csv(spark, path, CUSTOMER)


@query
def csv_rejects(spark, sf_dir):
    """Rows with a number that is none, a cell too few or a cell too many."""
    path = scratch_path(spark, "csv")
    key = F.col("c_custkey")
    cells = F.array(key.cast("string"), "c_name", F.lit("7"), F.when(key % 7 == 0, "much").otherwise("1.5"), F.lit("s"))
    cells = F.when(key % 7 == 1, F.slice(cells, 1, 4)).when(key % 7 == 2, F.array_append(cells, F.lit("t"))).otherwise(cells)
    table(spark, sf_dir, "customer").select(F.array_join(cells, ",", "").alias("value")).write.text(path)
    return rejected_csv(spark, path, CUSTOMER, header=False).select(F.col("_bad_row").alias("line"))


@query
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    table(spark, sf_dir, "customer").write.csv(path)
    return read_csv(spark, path, CUSTOMER, header=False)
