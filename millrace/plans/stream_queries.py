"""Registered streaming queries: the events table is read as a stream and drained, then the sink is read."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import detect_anomalies
from millrace.plans import roles
from millrace.plans.batch_queries import Query
from millrace.plans.roles import tables
from millrace.session import path_exists, scratch_path
from millrace.sinks import (
    latest_updates,
    read_snapshot,
    read_stored,
    write_files,
    write_snapshot,
    write_update_log,
    write_upserts,
)
from millrace.sources import stream_table
from millrace.streaming import (
    alert_messages,
    anomaly_counts,
    critical_window_counts,
    flat_window,
    hand_over,
    parse_readings,
    parse_transactions,
    read_breaches,
    read_output,
    read_view,
    running_metrics,
    start_alerts_and_counts,
    start_breach_stream,
    start_speed_layer,
)
from millrace.streaming.alerts import ALERTS, COUNTS, WINDOW_KEYS
from millrace.streaming.alerts import LATE as LATE_READINGS

STREAM: dict[str, Query] = {}
DRAIN = {"availableNow": True}


def query(run: Query) -> Query:
    STREAM[run.__name__] = run
    return run


# Parts of the events that arrive one after another.
ARRIVALS = 3


def _time_slices(events):
    """Conditions that cut the events into equal spans of time; rows without a time come first."""
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    if low is None:
        return [F.lit(True)]
    cuts = [F.lit(low + (high - low) * at / ARRIVALS).cast("timestamp_ntz") for at in range(1, ARRIVALS)]
    at = sum((F.coalesce((F.col("ts") >= cut).cast("int"), F.lit(0)) for cut in cuts), F.lit(0))
    return [at == part for part in range(ARRIVALS)]


# A file is read by one task, or as few as it has row groups, so what arrives is many files of so many rows.
ARRIVAL_ROWS = 250_000
# The stand-in for a source: folders that this process has laid the parts of the events out in.
_LAID_OUT: dict[tuple, tuple[str, int]] = {}


def _laid_out(spark, sf_dir, events, parts, named):
    """The events as folders `0.part`, `1.part`, ... in the order they arrive in; written once per process."""
    key = spark.sparkContext.applicationId, sf_dir, named
    path, n = _LAID_OUT.get(key, ("", 0))
    if not n or not path_exists(spark, f"{path}/{n - 1}.part/_SUCCESS"):
        path, conditions = scratch_path(spark, "arrivals"), parts or _time_slices(events)
        for at, part in enumerate(conditions):
            events.filter(part).write.option("maxRecordsPerFile", ARRIVAL_ROWS).parquet(f"{path}/{at}.part")
        _LAID_OUT[key] = path, len(conditions)
    return _LAID_OUT[key]


def _drain(spark, sf_dir, start, parts=None, named="slices", after=None):
    """Let parts of the events arrive one after another; the queries that `start` makes of the stream drain each.

    Every part is at least one micro-batch, and between parts the queries are restarted from their checkpoints.
    `after` is called with each part's number and the events that have arrived.
    """
    (events,) = tables(spark, sf_dir, "events", streaming=True)
    path, n = _laid_out(spark, sf_dir, events, parts, named)
    for at in range(n):
        arrived = f"{path}/{{{','.join(map(str, range(at + 1)))}}}.part"
        for each in start(lambda arrived=arrived: stream_table(spark, arrived, events.schema)):
            each.awaitTermination()
        if after:
            after(at, spark.read.schema(events.schema).parquet(*(f"{path}/{i}.part" for i in range(at + 1))))


def _readings(stream, keep=()):
    return parse_readings(roles.reading_messages(stream), keep)


def _snapshot(spark, sf_dir, aggregate):
    """Drain an aggregate in complete mode and read its last result."""
    path = scratch_path(spark, "stream")
    _drain(
        spark, sf_dir, lambda source: [write_snapshot(aggregate(source), f"{path}/out", f"{path}/checkpoint", DRAIN)]
    )
    return read_snapshot(spark, f"{path}/out")


def _appended(spark, sf_dir, rows):
    path = scratch_path(spark, "stream")
    _drain(spark, sf_dir, lambda source: [write_files(rows(source), f"{path}/out", f"{path}/checkpoint", DRAIN)])
    return spark.read.parquet(f"{path}/out")


@query
def alert_stream(spark, sf_dir):
    return _appended(spark, sf_dir, lambda source: alert_messages(_readings(source())))


@query
def critical_window_counts_stream(spark, sf_dir):
    return _snapshot(spark, sf_dir, lambda source: flat_window(critical_window_counts(_readings(source()))))


def _outputs(spark, sf_dir, parts=None, named="slices"):
    """The store that one read of the events has written alerts, counts and late readings to."""
    path = scratch_path(spark, "stream")

    def start(source):
        return [start_alerts_and_counts(_readings(source(), ("event_id",)), f"{path}/store", f"{path}/checkpoint", trigger=DRAIN)]

    _drain(spark, sf_dir, start, parts, named)
    return f"{path}/store"


@query
def critical_window_updates_stream(spark, sf_dir):
    """Window counts by an aggregation whose changed rows are merged into a stored table."""
    path = scratch_path(spark, "stream")

    def start(source):
        counts = flat_window(critical_window_counts(_readings(source())))
        return [write_upserts(counts, f"{path}/store", f"{path}/checkpoint", WINDOW_KEYS, trigger=DRAIN)]

    _drain(spark, sf_dir, start)
    return read_stored(spark, f"{path}/store")


@query
def alerts_and_counts_stream(spark, sf_dir):
    """Alerts with their texts and window counts, both of one start."""
    store = _outputs(spark, sf_dir)
    alerts = read_output(spark, store, ALERTS).groupBy(F.col("key").alias("sensor_id"), F.col("value").alias("entry"))
    counts = read_output(spark, store, COUNTS).select(
        F.lit("counts").alias("output"),
        "sensor_id",
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("entry"),
        F.col("critical_count").alias("n"),
    )
    alerts = alerts.agg(F.count("*").alias("n")).select(F.lit("alerts").alias("output"), "*")
    return alerts.unionByName(counts)


# Readings between these times come late.
LATE = ("2024-01-12", "2024-01-18")


def _late_parts(first):
    """Conditions of four arrivals: before the gap, what `first` says of the rest, critical ones of the gap, all other."""
    below, over = (F.col("ts") < F.lit(at).cast("timestamp_ntz") for at in LATE)
    critical = F.col("event_type") == "error"
    lot = F.when(below, 0).when(~over & first(critical), 1).when(over & critical, 2).otherwise(3)
    return [lot == at for at in range(4)]


def _late_counts(spark, sf_dir, advance_on):
    """Counts after a gap whose critical readings arrive when other readings are already past it."""
    path = scratch_path(spark, "stream")

    def start(source):
        counts = flat_window(critical_window_counts(_readings(source()), advance_on=advance_on))
        return [write_update_log(counts, f"{path}/out", f"{path}/checkpoint", DRAIN)]

    _drain(spark, sf_dir, start, _late_parts(lambda critical: ~critical), "late")
    return latest_updates(spark, f"{path}/out", WINDOW_KEYS)


@query
def late_window_counts_critical(spark, sf_dir):
    return _late_counts(spark, sf_dir, "critical")


@query
def late_window_counts_all(spark, sf_dir):
    return _late_counts(spark, sf_dir, "all")


@query
def late_readings_kept(spark, sf_dir):
    """Counted and late readings of a gap whose critical readings arrive after later critical ones."""
    store = _outputs(spark, sf_dir, _late_parts(lambda critical: critical), "overtaken")
    counted = read_output(spark, store, COUNTS).groupBy("sensor_id").agg(F.sum("critical_count").alias("n"))
    late = read_output(spark, store, LATE_READINGS).select(F.lit("late").alias("output"), "sensor_id", "event_id")
    counted = counted.select(F.lit("counted").alias("output"), "sensor_id", F.lit(None).cast("long").alias("event_id"), "n")
    return late.withColumn("n", F.lit(1).cast("long")).unionByName(counted)


@query
def anomaly_stream(spark, sf_dir):
    def rows(source):
        return detect_anomalies(_readings(source(), keep=("event_id",))).select("event_id", "sensor_id", "reasons")

    return _appended(spark, sf_dir, rows)


@query
def anomaly_counts_stream(spark, sf_dir):
    return _snapshot(spark, sf_dir, lambda source: anomaly_counts(_readings(source())))


@query
def running_metrics_stream(spark, sf_dir):
    def metrics(source):
        transactions = parse_transactions(roles.purchase_messages(source()))
        return running_metrics(_readings(source(), keep=("event_id",)), transactions, tie="event_id")

    return _snapshot(spark, sf_dir, metrics).withColumn("total_revenue", F.round("total_revenue", 2))


@query
def consecutive_breaches_stream(spark, sf_dir):
    path = scratch_path(spark, "stream")

    def start(source):
        events = source().select("user_id", "ts", "event_id", "value")
        over = F.col("value") > 50
        out = f"{path}/out", f"{path}/checkpoint"
        return [start_breach_stream(events, ["user_id"], ["ts", "event_id"], over, *out, trigger=DRAIN)]

    _drain(spark, sf_dir, start)
    return read_breaches(spark, f"{path}/out")


@query
def lambda_serving_view(spark, sf_dir):
    """Count, total and average per type from both layers, after the cut has moved twice while events arrived."""
    path = scratch_path(spark, "stream")
    keys, day = ["event_type"], F.unix_date(F.to_date("ts"))

    def start(source):
        return [start_speed_layer(source(), f"{path}/store", f"{path}/checkpoint", keys, "value", day, DRAIN)]

    def after(at, arrived):
        if at < ARRIVALS - 1:
            last = arrived.agg(F.max(day)).first()[0]
            hand_over(spark, f"{path}/store", arrived, keys, "value", day, last or 0)

    _drain(spark, sf_dir, start, after=after)
    view = read_view(spark, f"{path}/store", keys)
    return view.withColumn("total", F.round("total", 2)).withColumn("average", F.round("average", 2))
