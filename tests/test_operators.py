"""Operators on small frames with hand-checked or brute-force results, hot keys included."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace import operators as op
from millrace.functions import over_limits
from millrace.operators import ranking
from millrace.plans import sizing
from millrace.session import fit_to_inputs, plan_bytes, size_setting


def tuples(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


@pytest.fixture
def measured(monkeypatch):
    """No side counts as small by estimate, so sizes are measured."""
    monkeypatch.setattr(sizing, "small_by_estimate", lambda df: False)


@pytest.fixture
def nothing_fits(monkeypatch, measured):
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 0)


# Aggregates


def test_summarise_keeps_the_null_key(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (None, 4.0)], "k INT, v DOUBLE")
    result = op.summarise(df, ["k"], "n", {"v": "mean"}, {"v": "total"}, 2, ["k"])
    assert tuples(result) == [(None, 1, 4.0, 4.0), (1, 2, 1.0, 1.0)]


def test_rounding_is_half_up(spark):
    df = spark.createDataFrame([(1, 0.125)], "k INT, v DOUBLE")
    assert op.summarise(df, ["k"], averages={"v": "m"}, places=2).first().m == 0.13


def test_descending_order_by_aggregate(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 5.0), ("a", 1.5)], "k STRING, v DOUBLE")
    result = op.summarise(df, ["k"], sums={"v": "total"}, order=[F.desc("total")])
    assert tuples(result) == [("b", 5.0), ("a", 2.5)]


def test_counts_of_empty_input(spark):
    empty = spark.createDataFrame([], "k INT")
    assert op.total_count(empty).first()[0] == 0
    assert op.count_by(empty, "k").count() == 0


def test_group_topn_over_a_nested_path(spark):
    df = spark.sql(
        """SELECT type, named_struct('device', device) AS metadata, value FROM VALUES
           ('a', 'x', 1), ('a', 'x', 3), ('b', 'y', 5), ('a', 'y', 7), ('b', 'y', 9) AS t(type, device, value)"""
    )
    result = op.group_topn(df, {"type": "type", "device": "metadata.device"}, "value", 2)
    assert tuples(result) == [("a", "x", 2, 2.0, 4), ("b", "y", 2, 7.0, 14)]


def test_key_distribution(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 37)
    report = op.key_distribution(df, ["k"], 8)
    assert sum(r.row_count for r in report.collect()) == 1000
    assert sum(r.pct for r in report.collect()) == pytest.approx(100)
    # The report is where a hash exchange of that width really puts the rows.
    real = df.repartition(8, "k").groupBy(F.spark_partition_id().alias("bucket")).agg(F.count("*").alias("row_count"))
    assert tuples(report.select("bucket", "row_count"), "bucket") == tuples(real, "bucket")
    assert op.key_distribution(df.limit(0), ["k"], 8).count() == 0


# Rows


READING = "sensor_id STRING, temperature DOUBLE, humidity DOUBLE, status STRING"


def test_alert_edges(spark):
    rows = [
        ("exact", 30.0, 50.0, "normal"),
        ("hot", 31.0, 50.0, "normal"),
        ("crit", 10.0, 50.0, "critical"),
        ("null", None, 50.0, "critical"),
        ("nothing", None, None, None),
    ]
    alerts = {r.sensor_id: r.alert_msg for r in op.build_alerts(spark.createDataFrame(rows, READING)).collect()}
    assert alerts == {
        "hot": "ALERT: hot - temp=31.0 status=normal",
        "crit": "ALERT: crit - temp=10.0 status=critical",
        "null": None,
    }


def test_anomaly_edges(spark):
    rows = [
        ("t32", 32.0, 75.0, "normal"),
        ("t31", 31.0, 10.0, "normal"),
        ("all", 33.5, 80.25, "critical"),
        ("hum", None, 75.5, "warning"),
    ]
    found = {r.sensor_id: r.reasons for r in op.detect_anomalies(spark.createDataFrame(rows, READING)).collect()}
    assert found == {
        "all": "High temp: 33.5°C, Critical status, High humidity: 80.25%",
        "hum": "High humidity: 75.5%",
    }


def test_numbering_equals_one_global_sort(spark):
    values = random.Random(1).sample(range(10_000), 997)
    df = spark.createDataFrame([(v,) for v in values], "v INT").repartition(7)
    result = {r.v: r.anomaly_no for r in op.numbered(df, ["v"]).collect()}
    assert result == {v: i + 1 for i, v in enumerate(sorted(values))}


def test_size_gate_splits_the_input(spark):
    df = spark.createDataFrame([("a", 5), ("b", 6), ("c", None), ("d", 1)], "name STRING, size BIGINT")
    gate = op.size_gate(df, "size", 5)
    assert sorted(r.name for r in gate.kept.collect()) == ["a", "d"]
    assert sorted(r.name for r in gate.skipped.collect()) == ["b", "c"]
    assert tuple(gate.totals.first()) == (2, 6, 2, 6)


def test_tiny_fractions_choose_rows(spark):
    n = op.sample_rows(spark.range(0, 30_000_000, 1, 8), 4e-7, 1, ["id"]).count()
    assert 2 <= n <= 30
    assert op.sample_rows(spark.range(50), 1.0, 1, ["id"]).count() == 50
    assert op.sample_rows(spark.range(50), 0.0, 1, ["id"]).count() == 0
    with_null = spark.range(2000).selectExpr("nullif(id % 2, 0) AS k", "id")
    assert 800 < op.sample_rows(with_null, 0.5, 1, ["k", "id"]).count() < 1200
    for fraction in (1e-19, -0.1, 1.5):
        with pytest.raises(ValueError):
            op.sample_rows(spark.range(5), fraction, 1, ["id"])


def test_hashed_sample_does_not_depend_on_layout(spark):
    df = spark.range(20_000)
    a = sorted(r.id for r in op.sample_rows(df.repartition(3), 0.1, 5, ["id"]).collect())
    b = sorted(r.id for r in op.sample_rows(df.repartition(11), 0.1, 5, ["id"]).collect())
    other = sorted(r.id for r in op.sample_rows(df, 0.1, 6, ["id"]).collect())
    assert a == b and a != other
    assert 1700 < len(a) < 2300
    assert 1700 < op.sample_rows(df, 0.1, 5).count() < 2300


# Joins and nested queries


def skewed(spark, n, seed, nulls=True):
    rng = random.Random(seed)
    keys = [0 if rng.random() < 0.4 else rng.choice([None, *range(1, 9)] if nulls else range(1, 9)) for _ in range(n)]
    return keys, spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id INT, k INT")


def test_join_count_equals_the_join(spark):
    _, left = skewed(spark, 300, 1)
    _, right = skewed(spark, 200, 2)
    assert int(op.join_count(left, right, ["k"]).first()[0]) == left.join(right, "k").count()
    assert int(op.self_join_count(left, ["k"]).first()[0]) == left.join(left.toDF("i2", "k"), "k").count()
    assert int(op.join_count(left.limit(0), right, ["k"]).first()[0]) == 0


def test_join_count_of_samples(spark):
    _, df = skewed(spark, 2000, 3)
    a, b = (op.sample_rows(df, 0.2, s, ["id"]) for s in (1, 2))
    assert int(op.sample_join_count(df, ["k"], 0.2, (1, 2), ["id"]).first()[0]) == a.join(b, "k").count()
    assert op.sample_join_count(df, ["k"], 0.2, (1, 2)).count() == 1


def test_join_count_beyond_bigint(spark):
    billions = spark.range(4).select(F.lit(1).alias("k"))
    n = billions.agg(F.lit(4_000_000_000_000).cast("decimal(19,0)").alias("n"))
    squared = n.select((F.col("n") * F.col("n")).cast("decimal(38,0)")).first()[0]
    assert int(squared) == 16 * 10**24
    assert dict(op.self_join_count(billions, ["k"]).dtypes) == {"join_rows": "decimal(38,0)"}


@pytest.mark.parametrize("mode", ["small", "measured", "nothing_fits"])
def test_above_group_average(spark, request, mode):
    if mode != "small":
        request.getfixturevalue(mode)
    rng = random.Random(4)
    rows = [(i, rng.choice([None, 1, 1, 1, 2, 3]), float(rng.randrange(100))) for i in range(500)]
    df = spark.createDataFrame(rows, "id INT, k INT, v DOUBLE")
    groups = {}
    for _, k, v in rows:
        groups.setdefault(k, []).append(v)
    expected = sorted(i for i, k, v in rows if k is not None and v > sum(groups[k]) / len(groups[k]))
    result = op.above_group_average(df, "k", "v")
    assert result.columns == df.columns
    assert sorted(r.id for r in result.collect()) == expected


def test_above_average_and_in_other(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 6.0)], "k INT, v DOUBLE")
    assert tuples(op.above_average(df, "v")) == [(3, 6.0)]
    other = spark.createDataFrame([(1,), (1,), (3,), (None,)], "k INT")
    assert tuples(op.in_other(df, other, "k"), "k") == [(1, 1.0), (3, 6.0)]


# Ranking


def test_top_k_with_ties(spark):
    df = spark.createDataFrame([(1, 5), (2, 9), (3, 5), (4, 9), (5, None)], "id INT, v INT")
    assert tuples(op.top_k(df, [F.desc("v"), "id"], 3)) == [(2, 9), (4, 9), (1, 5)]


def test_top_k_in_levels_finds_the_same_rows(spark, monkeypatch, plan):
    df = spark.range(0, 3000, 1, 16).withColumn("v", F.pmod(F.hash("id"), F.lit(1000)))
    order = [F.desc("v"), "id"]
    direct = op.top_k(df, order, 50)
    monkeypatch.setattr(ranking, "MERGE_ROWS", 300)
    monkeypatch.setattr(ranking, "MERGE_GROUPS", 4)
    monkeypatch.setattr(ranking, "plan_bytes", lambda _: 1 << 40)
    leveled = op.top_k(df, order, 50)
    assert plan(leveled).count("WindowGroupLimit") == 2 and "WindowGroupLimit" not in plan(direct)
    assert tuples(leveled) == tuples(direct)
    assert leveled.columns == df.columns
    # Where even the groups would send too many rows to one task, the input is sorted by ranges.
    ranged = op.top_k(df, order, 500)
    assert "WindowGroupLimit" not in plan(ranged) and "TakeOrdered" not in plan(ranged)
    assert tuples(ranged) == tuples(df.orderBy(*order).limit(500))


@pytest.mark.parametrize("mode", ["small", "measured", "nothing_fits"])
def test_first_k_per_key(spark, request, mode):
    if mode != "small":
        request.getfixturevalue(mode)
    keys, df = skewed(spark, 600, 5)
    lookups = spark.createDataFrame([(k,) for k in (0, 0, 2, 2, 7, 99, None)], "k INT")
    expected = []
    for k in (0, 2, 7):
        expected += [(k, i) for i in [i for i, key in enumerate(keys) if key == k][:10]]
    result = op.first_k_per_key(df, lookups, "k", ["id"], 10)
    assert tuples(result.select("k", "id"), "k", "id") == expected


def test_latest_versions(spark):
    versions = [("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 1, "w")]
    df = spark.createDataFrame(versions, "row STRING, ts INT, v STRING")
    assert tuples(op.latest_versions(df, ["row"], [F.desc("ts")]), "row") == [("a", 3, "y"), ("b", 1, "w")]
    assert op.latest_versions(df, ["row"], [F.desc("ts")], 2).count() == 3


def test_versions_of_cells(spark):
    cells = [("r1", "info", "city", 1, "Oslo"), ("r1", "info", "city", 2, "Rome"), ("r1", "bill", "sum", 1, "9")]
    df = spark.createDataFrame(cells, "row_key STRING, family STRING, qualifier STRING, ts INT, value STRING")
    latest = op.latest_versions(df, ["row_key", "family", "qualifier"], [F.desc("ts")])
    assert tuples(latest.select("family", "value"), "family") == [("bill", "9"), ("info", "Rome")]


def test_limits(spark):
    df = spark.range(100)
    assert op.limit_rows(df, 7).count() == 7
    assert [r.id for r in op.preview(df, 3, ["id"]).collect()] == [0, 1, 2]
    assert op.preview(df).count() == 10


# Runs


def brute_force_hits(rows, n):
    """Ids of the n-th breach in a row per key; rows are (id, key, ts, value)."""
    hits, run = [], Counter()
    for i, k, _, v in sorted(rows, key=lambda r: (r[2], r[0])):
        run[k] = run[k] + 1 if v is not None and v > 5 else 0
        if run[k] == n:
            hits.append(i)
    return sorted(hits)


def run_rows(n, seed):
    rng = random.Random(seed)
    # Key 0 has more than a third of all rows, a NULL key is a key, and times tie.
    return [
        (i, 0 if rng.random() < 0.5 else rng.choice([None, 1, 2, 3]), rng.randrange(n // 3), rng.choice([1, 9, 9, 9, None]))
        for i in range(n)
    ]


RUN_SCHEMA = "id INT, k INT, ts INT, v INT"


def test_runs_of_three_two_and_six(spark):
    values = {"a": [9, 9, 9], "b": [9, 9, 1], "c": [9] * 6, "d": [9, 9, 1, 9, 9, 9]}
    rows = [(k, t, v) for k, vs in values.items() for t, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "k STRING, ts INT, v INT")
    hits = op.consecutive_breaches(df, ["k"], ["ts"], F.col("v") > 5)
    assert tuples(hits.select("k", "ts"), "k") == [("a", 2), ("c", 2), ("d", 5)]


@pytest.mark.parametrize("n", [1, 3, 4])
@pytest.mark.parametrize("group_rows", [10_000, 60, 7, 2])
def test_hot_keys_are_cut_without_changing_hits(spark, n, group_rows):
    rows = run_rows(400, n)
    df = spark.createDataFrame(rows, RUN_SCHEMA).repartition(5)
    hits = op.consecutive_breaches(df, ["k"], ["ts", "id"], F.col("v") > 5, n, group_rows=group_rows)
    assert hits.columns == df.columns
    assert sorted(r.id for r in hits.collect()) == brute_force_hits(rows, n)


def test_run_edges_and_leading_rows(spark):
    rows = run_rows(200, 9) + [(1000 + i, 77, 500 + i, 9) for i in range(2)] + [(2000, 78, 1, 1)]
    df = spark.createDataFrame(rows, RUN_SCHEMA)
    by_key = {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        by_key.setdefault(r[1], []).append((r[3] is not None and r[3] > 5, r[0]))
    edges = {r.k: (r.n_rows, r.all_breaches, r.last_run) for r in op.runs.run_edges(df, ["k"], ["ts", "id"], F.col("v") > 5).collect()}
    first = {}
    for r in op.runs.leading_rows(df, ["k"], ["ts", "id"], F.col("v") > 5).collect():
        first.setdefault(r.k, []).append((r._position, r.id))
    assert set(edges) == set(by_key)
    for k, seen in by_key.items():
        run = next((i for i, (b, _) in enumerate(reversed(seen)) if not b), len(seen))
        lead = next((i for i, (b, _) in enumerate(seen) if not b), len(seen))
        assert edges[k] == (min(len(seen), 3), all(b for b, _ in seen), min(run, 3))
        assert sorted(first.get(k, [])) == [(i + 1, id) for i, (_, id) in enumerate(seen[: min(lead, 3)])]


def test_process_samples(spark):
    samples = [
        (1, "a", 5.0, 1.0, 50.0, 1),
        (1, "a", 5.1, 1.0, 10.0, 2),
        (1, "a", 0.0, 9.0, 50.5, 3),
        (1, "a", 9.0, 9.0, 99.0, 4),
        (2, "b", None, 1.0, None, 1),
    ]
    df = spark.createDataFrame(
        samples, "pid INT, name STRING, cpu_pct DOUBLE, mem_pct DOUBLE, mem_mb DOUBLE, sampled_at INT"
    )
    assert [r.sampled_at for r in op.process_alerts(df).orderBy("sampled_at").collect()] == [2, 3, 4]
    third = op.consecutive_breaches(df, ["pid"], ["sampled_at"], over_limits())
    assert [(r.pid, r.sampled_at) for r in third.collect()] == [(1, 4)]


# Mutation


@pytest.mark.parametrize("mode", ["small", "measured", "nothing_fits"])
def test_increment_first(spark, request, mode):
    if mode != "small":
        request.getfixturevalue(mode)
    rows = [(1, "a", 10), (2, "a", 20), (3, "b", 30), (4, None, 40), (5, "c", None)]
    df = spark.createDataFrame(rows, "id INT, k STRING, value INT")
    updates = spark.createDataFrame([("a",), ("a",), ("zz",), (None,), ("c",)], "k STRING")
    result = op.increment_first(df, updates, "k", ["id"], "value")
    assert result.dtypes == df.dtypes
    assert tuples(result, "id") == [(1, "a", 12), (2, "a", 20), (3, "b", 30), (4, None, 40), (5, "c", None)]


def test_increment_first_sets_the_stamp(spark):
    df = spark.createDataFrame([(1, 5, "a", 1), (1, 4, "a", 2), (2, 1, "b", 3)], "hi INT, lo INT, k STRING, value INT")
    updates = spark.createDataFrame([("a",)], "k STRING")
    once = op.increment_first(df, updates, "k", ["hi", "lo"], "value", step=10, stamp=F.lit(7.5))
    assert tuples(once, "value") == [(1, 5, "a", 1, None), (2, 1, "b", 3, None), (1, 4, "a", 12, 7.5)]
    later = spark.createDataFrame([("b",)], "k STRING")
    again = op.increment_first(once, later, "k", ["hi", "lo"], "value", stamp=F.lit(8.5))
    assert tuples(again.select("value", "lastUpdate"), "value") == [(1, None), (4, 8.5), (12, 7.5)]


# Placement and sizes


def test_placement(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 10)
    cached, rows = op.cache_table(df)
    assert rows == 100 and cached.is_cached
    cached.unpersist()
    assert op.repartition_evenly(df, 5).rdd.getNumPartitions() == 5
    placed = op.repartition_by_key(df, 5, "k").withColumn("p", F.spark_partition_id())
    assert placed.groupBy("k").agg(F.count_distinct("p").alias("n")).filter("n > 1").count() == 0


def test_sizes(spark, sf_dir):
    sizes = {"134217728b": 1 << 27, "128MB": 1 << 27, "1g": 1 << 30, "512k": 1 << 19, "-1": -1}
    assert {text: size_setting(text) for text in sizes} == sizes
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    assert 100_000 < plan_bytes(orders) < 10_000_000
    assert fit_to_inputs(spark, orders) == (128 << 20, 8)
    assert sizing.measured_bytes(orders.limit(0)) == 0
    assert sizing.measured_bytes(spark.range(10)) > 10 * 64


def test_inputs_raise_sizes_and_give_them_back(spark, monkeypatch):
    from millrace import session

    small, huge = spark.range(1), spark.range(1)
    monkeypatch.setattr(session, "plan_bytes", lambda df: 100 << 40 if df is huge else 1)
    split, width = fit_to_inputs(spark, huge, small)
    assert split == (100 << 40) // session.MAX_TASKS and width == session.MAX_SHUFFLE_WIDTH
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert fit_to_inputs(spark, huge, streaming=True)[1] == session.MAX_STREAM_WIDTH
    assert spark.conf.get("spark.sql.shuffle.partitions") == str(session.MAX_STREAM_WIDTH)
    assert fit_to_inputs(spark, small) == (128 << 20, 8)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    assert fit_to_inputs(spark, small)[1] == 6
    spark.conf.set("spark.sql.shuffle.partitions", "8")
