"""Streams replayed from ordered files, one file per micro-batch."""

import json
import os
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StructType
from test_operators import RUN_SCHEMA, brute_force_hits, run_rows

from millrace.session import scratch_path
from millrace.sinks import (
    latest_updates,
    read_snapshot,
    read_stored,
    stored_version,
    write_files,
    write_snapshot,
    write_update_log,
    write_updates,
)
from millrace.sources import read_topic, stream_table
from millrace.streaming import (
    alert_messages,
    anomaly_counts,
    critical_window_counts,
    flat_window,
    hand_over,
    parse_readings,
    partial_aggregate,
    read_breaches,
    read_output,
    read_view,
    running_metrics,
    serving_view,
    start_alerts_and_counts,
    start_breach_stream,
    start_speed_layer,
)
from millrace.streaming import alerts as alerts_module
from millrace.streaming import breaches as breaches_module
from millrace.streaming.alerts import ALERTS, COUNTS
from millrace.streaming.alerts import LATE as LATE_READINGS

DRAIN = {"availableNow": True}
MESSAGE = "value STRING"


def reading(second, status="normal", sensor="S1", temperature=20.0, humidity=50.0):
    return json.dumps(
        {
            "sensor_id": sensor,
            "timestamp": f"2024-01-01T00:00:{second:02d}",
            "temperature": temperature,
            "humidity": humidity,
            "status": status,
        }
    )


class Topic:
    """A folder of text files; each file is one micro-batch, in the order of their times."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.files = spark, folder, 0
        folder.mkdir()

    def send(self, *values):
        path = self.folder / f"{self.files:03d}.json"
        path.write_text("\n".join(values) + "\n")
        os.utime(path, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1

    def stream(self):
        return self.spark.readStream.option("maxFilesPerTrigger", 1).text(str(self.folder))


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


@pytest.fixture
def scratch(spark):
    return scratch_path(spark, "test")


LATE = [[1, 2, 6], [20], [3, 14, 16], [30]]
LATE_STATUS = ["critical", "normal", "critical", "critical"]


def watermark(query):
    return [p["eventTime"].get("watermark") for p in query.recentProgress if p["numInputRows"]]


@pytest.mark.parametrize(
    "advance_on, expected",
    [
        # Only critical rows move the watermark: it is at second 1 when 3 and 14 arrive, so both count.
        ("critical", {0: 3, 5: 1, 10: 1, 15: 1, 30: 1}),
        # The normal row at 20 moves it to 15: the windows of 3 and 14 are over.
        ("all", {0: 2, 5: 1, 15: 1, 30: 1}),
    ],
)
def test_late_rows(spark, topic, scratch, advance_on, expected):
    counts = critical_window_counts(parse_readings(topic.stream()), advance_on=advance_on)
    query = write_update_log(counts, f"{scratch}/out", f"{scratch}/cp")
    # One file at a time: a new watermark counts as reached only after a batch that ran with it.
    for seconds, status in zip(LATE, LATE_STATUS):
        topic.send(*(reading(s, status) for s in seconds))
        query.processAllAvailable()
    query.stop()
    latest = latest_updates(spark, f"{scratch}/out", ["window", "sensor_id"])
    assert {r.window.start.second: r.critical_count for r in latest.collect()} == expected
    marks = [m for m in watermark(query) if m]
    assert marks[2] == ("2024-01-01T00:00:01.000Z" if advance_on == "critical" else "2024-01-01T00:00:15.000Z")


def test_unknown_watermark_choice(spark):
    frame = spark.createDataFrame([], "event_time TIMESTAMP, sensor_id STRING, status STRING")
    with pytest.raises(ValueError):
        critical_window_counts(frame, advance_on="none")


def test_alerts_restart_without_duplicates(spark, topic, scratch):
    def drain():
        messages = alert_messages(parse_readings(topic.stream()))
        write_files(messages, f"{scratch}/out", f"{scratch}/cp", DRAIN).awaitTermination()
        return sorted((r.key, json.loads(r.value)) for r in spark.read.parquet(f"{scratch}/out").collect())

    topic.send(reading(1, temperature=31.0), reading(2, temperature=30.0), "{broken")
    first = drain()
    text = "ALERT: S1 - temp=31.0 status=normal"
    assert first == [("S1", {"sensor_id": "S1", "temperature": 31.0, "status": "normal", "alert_msg": text})]
    topic.send(reading(3, "critical", sensor="S2", temperature=None))
    second = drain()
    assert second == first + [("S2", {"sensor_id": "S2", "status": "critical"})]
    assert drain() == second


def outputs(spark, store):
    alerts = sorted((r.key, json.loads(r.value)["status"]) for r in read_output(spark, store, ALERTS).collect())
    counts = sorted((r.window_start.second, r.critical_count) for r in read_output(spark, store, COUNTS).collect())
    return alerts, counts, sorted(r.event_time.second for r in read_output(spark, store, LATE_READINGS).collect())


def test_alerts_and_counts_come_from_one_read(spark, topic, scratch):
    topic.send(reading(1, "critical"), reading(2, "critical", temperature=33.0), reading(3), "{broken")
    topic.send(reading(7, "critical"), reading(8, temperature=40.0))

    def start():
        return start_alerts_and_counts(parse_readings(topic.stream()), f"{scratch}/out", f"{scratch}/cp", trigger=DRAIN)

    query = start()
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 6
    expected = [("S1", "critical")] * 3 + [("S1", "normal")], [(0, 2), (5, 1)], []
    assert outputs(spark, f"{scratch}/out") == expected
    start().awaitTermination()
    assert outputs(spark, f"{scratch}/out") == expected


@pytest.mark.parametrize("killed_at", ["counts", "commit"])
def test_both_outputs_of_a_batch_or_neither(spark, topic, scratch, monkeypatch, killed_at):
    def start():
        return start_alerts_and_counts(parse_readings(topic.stream()), f"{scratch}/out", f"{scratch}/cp", trigger=DRAIN)

    topic.send(reading(1, "critical"))
    start().awaitTermination()
    before = outputs(spark, f"{scratch}/out")
    topic.send(reading(2, "critical"), reading(9, temperature=50.0))

    def die(*_):
        raise RuntimeError("killed")

    # The alerts of the batch are written by then.
    monkeypatch.setattr(alerts_module, {"counts": "merged_files", "commit": "commit"}[killed_at], die)
    with pytest.raises(Exception, match="killed"):
        start().awaitTermination()
    assert outputs(spark, f"{scratch}/out") == before
    monkeypatch.undo()
    start().awaitTermination()
    assert outputs(spark, f"{scratch}/out") == ([("S1", "critical")] * 2 + [("S1", "normal")], [(0, 2)], [])


def test_late_readings_are_those_the_watermark_drops(spark, topic, scratch):
    counts = critical_window_counts(parse_readings(topic.stream()))
    native = write_update_log(counts, f"{scratch}/native", f"{scratch}/cp1")
    for values in ([1, 6], [20], [3, 14, 16, 26], [2, 40, 41], [24, 39], [30, 45]):
        topic.send(*(reading(s, "critical") for s in values))
        native.processAllAvailable()
    native.stop()
    store = f"{scratch}/out"
    start_alerts_and_counts(parse_readings(topic.stream()), store, f"{scratch}/cp2", trigger=DRAIN).awaitTermination()
    alerts, kept, late = outputs(spark, store)
    latest = latest_updates(spark, f"{scratch}/native", ["window", "sensor_id"])
    assert kept == sorted((r.window.start.second, r.critical_count) for r in latest.collect())
    dropped = sum(s["numRowsDroppedByWatermark"] for p in native.recentProgress for s in p["stateOperators"])
    assert late == [2, 3, 14, 24, 30] and dropped == stored_version(spark, store).notes["late"] == 5
    assert len(alerts) == len(late) + sum(n for _, n in kept)


def test_complete_mode_equals_batch(spark, topic, scratch):
    rng = random.Random(1)
    sent = []
    for _ in range(3):
        rows = [reading(rng.randrange(60), rng.choice(["critical", "normal"]), f"S{rng.randrange(3)}") for _ in range(40)]
        sent += rows
        topic.send(*rows)
    counts = flat_window(critical_window_counts(parse_readings(topic.stream())))
    write_snapshot(counts, f"{scratch}/out", f"{scratch}/cp", DRAIN).awaitTermination()
    batch = parse_readings(spark.createDataFrame([(s,) for s in sent], MESSAGE))
    expected = flat_window(critical_window_counts(batch))
    assert sorted(map(tuple, read_snapshot(spark, f"{scratch}/out").collect())) == sorted(map(tuple, expected.collect()))


def test_anomaly_totals_over_batches(spark, topic, scratch):
    topic.send(reading(1, temperature=32.0), reading(2, temperature=32.5), "{broken")
    topic.send(reading(3, humidity=75.0), reading(4, humidity=75.5), reading(5, "critical", temperature=40.0))
    counts = anomaly_counts(parse_readings(topic.stream()))
    write_snapshot(counts, f"{scratch}/out", f"{scratch}/cp", DRAIN).awaitTermination()
    assert tuple(read_snapshot(spark, f"{scratch}/out").first()) == (6, 3)


def test_running_metrics_over_two_topics(spark, topic, scratch, tmp_path):
    topic.send(reading(5, temperature=21.5), reading(9, temperature=22.5))
    topic.send(reading(7, temperature=99.0))
    payments = Topic(spark, tmp_path / "payments")
    payments.send(json.dumps({"amount": 5.25}), json.dumps({"amount": None}))
    payments.send(json.dumps({"amount": 1.5}), json.dumps({}))
    transactions = payments.stream().select(F.from_json("value", "amount DOUBLE").getField("amount").alias("amount"))
    metrics = running_metrics(parse_readings(topic.stream()), transactions)
    write_snapshot(metrics, f"{scratch}/out", f"{scratch}/cp", DRAIN).awaitTermination()
    assert tuple(read_snapshot(spark, f"{scratch}/out").first()) == (3, 22.5, 4, 6.75)


def test_metrics_without_input_are_zero(spark):
    sensors = spark.createDataFrame([], "temperature DOUBLE, event_time TIMESTAMP, sensor_id STRING")
    transactions = spark.createDataFrame([], "amount DOUBLE")
    assert tuple(running_metrics(sensors, transactions).first()) == (0, 0.0, 0, 0.0)


def test_missing_temperature_counts_as_zero(spark):
    sensors = spark.sql("SELECT CAST(NULL AS DOUBLE) AS temperature, timestamp'2024-01-01' AS event_time, 'S1' AS sensor_id")
    transactions = spark.createDataFrame([], "amount DOUBLE")
    assert tuple(running_metrics(sensors, transactions).first()) == (1, 0.0, 0, 0.0)


@pytest.mark.parametrize("group_rows", [10_000, 15])
def test_breaches_over_batches_and_restarts(spark, scratch, tmp_path, group_rows):
    rows = sorted(run_rows(240, 11), key=lambda r: (r[2], r[0]))
    folder = str(tmp_path / "rows")
    schema = StructType.fromDDL(RUN_SCHEMA)

    def drain():
        stream = stream_table(spark, folder, schema, files_per_trigger=1)
        start_breach_stream(
            stream, ["k"], ["ts", "id"], F.col("v") > 5, f"{scratch}/out", f"{scratch}/cp", 3, DRAIN, group_rows
        ).awaitTermination()
        return sorted(r.id for r in read_breaches(spark, f"{scratch}/out").collect())

    done = 0
    for size in (3, 100, 1, 90, 46):
        part = spark.createDataFrame(rows[done : done + size], schema)
        part.coalesce(1).write.mode("append").parquet(folder)
        done += size
        assert drain() == brute_force_hits(rows[:done], 3)
    assert drain() == brute_force_hits(rows, 3)
    for part in ("edges", "runs"):
        kept = os.listdir(f"{scratch}/cp/open_runs/{part}".removeprefix("file:"))
        assert sorted(k for k in kept if k.startswith("batch")) == ["batch_id=2", "batch_id=3", "batch_id=4"]


class Progress(StreamingQueryListener):
    """What the state of the open runs did, batch by batch."""

    def __init__(self):
        self.seen = []

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        if event.progress.name == "open_runs" and event.progress.numInputRows:
            (state,) = event.progress.stateOperators
            self.seen.append((state.numRowsTotal, state.numRowsUpdated, state.numRowsRemoved))

    def onQueryTerminated(self, event):
        pass


def test_a_batch_touches_the_state_of_its_own_keys(spark, scratch, tmp_path):
    folder, n_keys = str(tmp_path / "rows"), 50_000
    schema = StructType.fromDDL("k LONG, ts INT, v INT")
    batches = [
        spark.range(n_keys).selectExpr("id AS k", "1 AS ts", "9 AS v"),
        spark.createDataFrame([(5, 2, 9)], schema),
        spark.createDataFrame([(5, 3, 9), (6, 3, 1), (None, 3, 9)], schema),
        spark.createDataFrame([(5, 4, 9), (None, 4, 9), (None, 5, 9)], schema),
    ]
    listener = Progress()
    spark.streams.addListener(listener)
    try:
        for batch in batches:
            batch.write.mode("append").parquet(folder)
            stream = stream_table(spark, folder, schema)
            start_breach_stream(
                stream, ["k"], ["ts"], F.col("v") > 5, f"{scratch}/out", f"{scratch}/cp", 3, DRAIN
            ).awaitTermination()
        for _ in range(100):
            if len(listener.seen) == len(batches):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    hits = sorted((r.k or -1, r.ts) for r in read_breaches(spark, f"{scratch}/out").collect())
    assert hits == [(-1, 5), (5, 3)]
    assert listener.seen == [(n_keys, n_keys, 0), (n_keys, 1, 0), (n_keys, 2, 1), (n_keys, 1, 0)]


class Entries:
    """A map state in memory, with the keys it was asked for."""

    def __init__(self, runs):
        self.runs, self.asked = runs, []

    def getValue(self, key):  # noqa: N802
        self.asked.append(key[0])
        return self.runs.get(key)

    def updateValue(self, key, value):  # noqa: N802
        self.runs[key] = value

    def removeKey(self, key):  # noqa: N802
        del self.runs[key]


def test_a_call_steps_many_keys():
    step = breaches_module.carry_runs(3)
    step.runs = Entries({("b",): (2,), ("c",): (1,), ("d",): (3,), ("other",): (1,)})
    edges = [("d", 5, 1, True, 1), ("a", 5, 2, True, 2), ("b", 6, 3, False, 0), ("c", 5, 3, False, 2), ("b", 5, 1, True, 1)]
    frames = [pd.DataFrame(part, columns=breaches_module.EDGE_COLUMNS) for part in (edges[:2], edges[2:])]
    (found,) = step.handleInputRows((0,), iter(frames), None)
    assert found.values.tolist() == [["b", 5, 2], ["b", 6, 3], ["c", 5, 1], ["d", 5, 3]]
    assert step.runs.runs == {("a",): (2,), ("c",): (2,), ("d",): (3,), ("other",): (1,)}
    assert step.runs.asked == ["a", "b", "c", "d"]


def test_a_batch_that_is_replayed_reports_the_same(spark, scratch, tmp_path, monkeypatch):
    folder, schema = str(tmp_path / "rows"), StructType.fromDDL("k LONG, ts INT, v INT")

    def drain():
        stream = stream_table(spark, folder, schema)
        args = ["k"], ["ts"], F.col("v") > 5, f"{scratch}/out", f"{scratch}/cp", 3, DRAIN
        start_breach_stream(stream, *args).awaitTermination()

    spark.createDataFrame([(1, 1, 9), (1, 2, 9), (2, 1, 9)], schema).write.mode("append").parquet(folder)
    drain()
    spark.createDataFrame([(1, 3, 9), (2, 2, 1)], schema).write.mode("append").parquet(folder)

    def die(*_):
        raise RuntimeError("killed")

    # The state has taken the batch in by then.
    monkeypatch.setattr(breaches_module, "leading_rows", die)
    with pytest.raises(Exception, match="killed"):
        drain()
    monkeypatch.undo()
    drain()
    assert [tuple(r) for r in read_breaches(spark, f"{scratch}/out").collect()] == [(1, 3, 9)]


def test_serving_view_equals_recomputing(spark, scratch, tmp_path):
    rng = random.Random(2)
    rows = [(rng.choice("abc"), rng.randrange(100), rng.choice([None, 1.0, 2.0, 4.0])) for _ in range(500)]
    df = spark.createDataFrame(rows, "k STRING, ts INT, v DOUBLE").repartition(3)
    batch = partial_aggregate(df.filter("ts < 60"), ["k"], "v")
    folder = str(tmp_path / "recent")
    df.filter("ts >= 60").write.parquet(folder)
    speed = partial_aggregate(stream_table(spark, folder, df.schema, 1), ["k"], "v")
    write_snapshot(speed, f"{scratch}/out", f"{scratch}/cp", DRAIN).awaitTermination()
    view = serving_view(batch, read_snapshot(spark, f"{scratch}/out"), ["k"])
    expected = df.groupBy("k").agg(F.count("*").alias("count"), F.sum("v").alias("total"), F.avg("v").alias("average"))
    assert sorted(map(tuple, view.collect())) == sorted(map(tuple, expected.collect()))


def test_the_cut_moves_while_the_stream_goes_on(spark, scratch, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *range(100)]), rng.choice([None, 1.0, 2.0])) for _ in range(400)]
    schema = StructType.fromDDL("k STRING, ts INT, v DOUBLE")
    folder, store, slot = str(tmp_path / "rows"), f"{scratch}/store", F.floor(F.col("ts") / 10).cast("int")

    def view_equals(seen):
        df = spark.createDataFrame(seen, schema)
        expected = df.groupBy("k").agg(F.count("*").alias("count"), F.sum("v").alias("total"), F.avg("v").alias("average"))
        assert sorted(map(tuple, read_view(spark, store, ["k"]).collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)

    with pytest.raises(FileNotFoundError):
        read_view(spark, store, ["k"])
    for at, cut in enumerate((3, 7, None, 10)):
        seen = rows[: (at + 1) * 100]
        spark.createDataFrame(rows[at * 100 : at * 100 + 100], schema).write.mode("append").parquet(folder)
        stream = stream_table(spark, folder, schema)
        start_speed_layer(stream, store, f"{scratch}/cp", ["k"], "v", slot, DRAIN).awaitTermination()
        view_equals(seen)
        if cut:
            hand_over(spark, store, spark.createDataFrame(seen, schema), ["k"], "v", slot, cut)
            view_equals(seen)
            assert stored_version(spark, store).notes["cut"] == cut
            speed = read_stored(spark, store, "speed_view")
            assert speed.filter(F.col("slot") < cut).count() == 0
    assert read_stored(spark, store, "speed_view").count() == 0


def test_serving_view_of_a_key_without_values(spark):
    df = spark.createDataFrame([("a", None)], "k STRING, v DOUBLE")
    part = partial_aggregate(df, ["k"], "v")
    assert tuple(serving_view(part, part.limit(0), ["k"]).first()) == ("a", 1, None, None)


def test_stream_of_a_single_file_and_of_a_folder(spark, sf_dir, tmp_path, scratch):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    for at, path in enumerate((f"{sf_dir}/events.parquet", str(tmp_path / "events.parquet"))):
        stream = stream_table(spark, path, events.schema)
        write_files(stream, f"{scratch}/out{at}", f"{scratch}/cp{at}", DRAIN).awaitTermination()
        assert spark.read.parquet(f"{scratch}/out{at}").count() == events.count()


def test_console_sink_in_update_mode(spark, topic, scratch):
    topic.send(reading(1, "critical"))
    counts = critical_window_counts(parse_readings(topic.stream()))
    query = write_updates(counts, f"{scratch}/cp", trigger=DRAIN)
    query.awaitTermination()
    assert query.exception() is None


def test_topic_source_needs_the_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_topic(spark, "sensors", starting="earliest", group_id="g", max_per_trigger=10)


def test_arrivals_are_files_of_bounded_rows(spark, sf_dir, monkeypatch):
    from millrace.plans import stream_queries

    monkeypatch.setattr(stream_queries, "ARRIVAL_ROWS", 500)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").coalesce(1)
    path, n = stream_queries._laid_out(spark, sf_dir, events, [F.lit(True)], "bounded")
    arrived = spark.read.parquet(f"{path}/0.part")
    assert n == 1 and arrived.count() == events.count() > 500
    assert arrived.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 500
