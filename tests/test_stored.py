"""Stored tables: what readers see during and after changes, which files a change touches, and what a crash leaves."""

import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import increment_first
from millrace.sinks import (
    ConcurrentChange,
    append_rows,
    expire_versions,
    increment_stored,
    read_stored,
    replace_rows,
    stored,
    stored_version,
    upsert_rows,
    write_upserts,
)
from millrace.sources import stream_table


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "store")


def ids(df):
    return sorted(r.id for r in df.collect())


def data_files(path):
    found = {}
    for folder, _, names in os.walk(f"{path}/data"):
        found.update({f"{folder}/{n}": os.stat(f"{folder}/{n}").st_mtime_ns for n in names if n.startswith("part-")})
    return found


class Crash(Exception):
    pass


@pytest.fixture
def crashing(monkeypatch):
    """Every commit crashes, as if the writer had died after its data files were written."""

    def die(*_, **__):
        raise Crash

    def start(module=stored):
        monkeypatch.setattr(module, "commit", die)

    yield start
    monkeypatch.undo()


def test_readers_see_one_version_or_the_other(spark, path):
    replace_rows(spark.range(5), path)
    planned = read_stored(spark, path)
    replace_rows(spark.range(10, 12), path)
    assert ids(planned) == [0, 1, 2, 3, 4] and ids(read_stored(spark, path)) == [10, 11]
    assert ids(read_stored(spark, path, number=0)) == [0, 1, 2, 3, 4]
    # A table may be replaced by a part of itself.
    replace_rows(read_stored(spark, path).filter("id = 11"), path)
    assert ids(read_stored(spark, path)) == [11]
    replace_rows(spark.range(0), path)
    assert ids(read_stored(spark, path)) == []


@pytest.mark.parametrize("change", ["replace", "append", "upsert", "increment"])
def test_a_crash_before_the_switch_changes_nothing(spark, path, crashing, monkeypatch, change):
    rows = spark.range(20).selectExpr("id", "id % 4 AS k", "CAST(1.0 AS DOUBLE) AS v")
    upsert_rows(rows, path, ["id"], buckets=4) if change == "upsert" else replace_rows(rows, path)
    before, files = sorted(map(tuple, read_stored(spark, path).collect())), data_files(path)
    crashing()
    changes = {
        "replace": lambda: replace_rows(rows.limit(1), path),
        "append": lambda: append_rows(rows, path),
        "upsert": lambda: upsert_rows(rows.withColumn("v", F.lit(2.0)), path, ["id"]),
        "increment": lambda: increment_stored(spark, path, rows.select("k"), "k", ["id"], "v"),
    }
    with pytest.raises(Crash):
        changes[change]()
    assert sorted(map(tuple, read_stored(spark, path).collect())) == before
    assert files.items() <= data_files(path).items() and len(data_files(path)) > len(files)
    monkeypatch.undo()
    changes[change]()
    assert sorted(map(tuple, read_stored(spark, path).collect())) != before


def test_an_append_that_comes_again_adds_nothing(spark, path):
    for batch in (0, 1, 1, 0, 2):
        append_rows(spark.range(batch * 10, batch * 10 + 2), path, batch=("load", batch))
    append_rows(spark.range(90, 91), path, batch=("other", 0))
    append_rows(spark.range(99, 100), path)
    assert ids(read_stored(spark, path)) == [0, 1, 10, 11, 20, 21, 90, 99]


def test_of_two_writers_the_second_fails(spark, path):
    first = replace_rows(spark.range(1), path)
    replace_rows(spark.range(2), path)
    with pytest.raises(ConcurrentChange):
        stored.commit(spark, path, first, {})
    assert stored_version(spark, path).number == 1
    assert sorted(os.listdir(f"{path}/versions"))[-1] == "000000000001.json"


def test_only_files_with_a_row_to_change_are_written(spark, path):
    rows = spark.range(8000).selectExpr("id", "id % 1000 AS k", "CAST(0 AS DOUBLE) AS v").repartitionByRange(8, "id")
    replace_rows(rows, path)
    before = data_files(path)
    assert len(before) == 8
    # Keys 10 and 20 have their first rows in the first file; key 5000 has none.
    updates = spark.createDataFrame([(10,), (20,), (10,), (5000,), (None,)], "k LONG")
    version = increment_stored(spark, path, updates, "k", ["id"], "v", step=3)
    after = data_files(path)
    assert before.items() <= after.items() and len(after) == 9
    named = {place for place, _ in version.files()}
    assert len(named) == 8 and len(named & {f.removeprefix(f"{path}/") for f in before}) == 7
    got = {r.id: r.v for r in read_stored(spark, path).filter("v > 0").collect()}
    assert got == {10: 6.0, 20: 3.0} and read_stored(spark, path).count() == 8000
    # Nothing to change: nothing is written.
    increment_stored(spark, path, updates.filter("k = 5000"), "k", ["id"], "v")
    assert data_files(path) == after


def test_stored_increments_equal_those_of_a_frame(spark, path):
    rng = random.Random(4)
    rows = [(i, rng.choice([None, 7, 7, 7, *range(20)]), rng.random(), None) for i in range(600)]
    df = spark.createDataFrame(rows, "id LONG, k LONG, v DOUBLE, at DOUBLE").repartition(5)
    updates = spark.createDataFrame([(rng.choice([None, 7, *range(30)]),) for _ in range(200)], "k LONG")
    replace_rows(df, path)
    for batch in (0, 0):
        increment_stored(spark, path, updates, "k", ["id"], "v", 2, F.lit(5.0), "at", batch=("updates", batch))
    expected = increment_first(df, updates, "k", ["id"], "v", 2, F.lit(5.0), "at")
    assert sorted(map(tuple, read_stored(spark, path).collect())) == sorted(map(tuple, expected.collect()))


def test_an_upsert_of_one_key_writes_one_bucket(spark, path):
    rows = spark.range(4000).selectExpr("id", "CAST(NULL AS STRING) AS name", "id AS v")
    first = upsert_rows(rows, path, ["id"], buckets=16)
    assert len({bucket for _, bucket in first.files()}) == 16
    planned, before = read_stored(spark, path), data_files(path)
    # The number of buckets stays that of the first write.
    second = upsert_rows(spark.createDataFrame([(5, "x", -1)], rows.schema), path, ["id"], buckets=3)
    changed = {tuple(f) for f in second.files()} - {tuple(f) for f in first.files()}
    assert len({bucket for _, bucket in changed}) == 1 and before.items() <= data_files(path).items()
    got = {r.id: (r.name, r.v) for r in read_stored(spark, path).collect()}
    assert len(got) == 4000 and got[5] == ("x", -1) and got[6] == (None, 6)
    assert planned.filter("v < 0").count() == 0 and planned.count() == 4000


def test_null_keys_are_keys(spark, path):
    schema = "a INT, b STRING, v INT"
    upsert_rows(spark.createDataFrame([(1, None, 1), (None, None, 2), (1, "x", 3)], schema), path, ["a", "b"], buckets=2)
    upsert_rows(spark.createDataFrame([(1, None, 10), (None, None, 20), (2, None, 30)], schema), path, ["a", "b"])
    got = sorted(map(tuple, read_stored(spark, path).collect()), key=str)
    assert got == sorted([(1, None, 10), (None, None, 20), (1, "x", 3), (2, None, 30)], key=str)
    assert upsert_rows(spark.createDataFrame([], schema), path, ["a", "b"]).number == 2


def test_versions_expire_with_the_files_only_they_name(spark, path):
    append_rows(spark.range(1), path)
    for at in range(1, 6):
        append_rows(spark.range(at, at + 1), path) if at != 3 else replace_rows(spark.range(30, 31), path)
    assert expire_versions(spark, path, versions=2) == 0
    assert expire_versions(spark, path, versions=2, seconds=0) == 4
    assert sorted(os.listdir(f"{path}/versions")) and stored_version(spark, path).number == 5
    assert ids(read_stored(spark, path)) == [4, 5, 30] and ids(read_stored(spark, path, number=4)) == [4, 30]
    assert len([f for f in data_files(path)]) == len(stored_version(spark, path).files())


def test_upserts_of_a_stream_survive_a_crash_and_a_restart(spark, path, tmp_path, crashing, monkeypatch):
    folder, schema = str(tmp_path / "rows"), "k INT, v INT"
    rows = [(i % 7, i) for i in range(60)]
    for at in range(3):
        spark.createDataFrame(rows[at * 20 : at * 20 + 20], schema).coalesce(1).write.mode("append").parquet(folder)

    def drain():
        stream = stream_table(spark, folder, spark.createDataFrame([], schema).schema, 1)
        sums = stream.groupBy("k").agg(F.sum("v").alias("v"))
        write_upserts(sums, path, f"{tmp_path}/cp", ["k"], 4, {"availableNow": True}).awaitTermination()

    crashing()
    with pytest.raises(Exception, match="Crash"):
        drain()
    monkeypatch.undo()
    drain()
    expected = {k: sum(v for j, v in rows if j == k) for k in range(7)}
    assert {r.k: r.v for r in read_stored(spark, path).collect()} == expected
    assert stored_version(spark, path).notes == {"batch:stream": 2}
    drain()
    assert {r.k: r.v for r in read_stored(spark, path).collect()} == expected


def test_no_such_table(spark, path):
    with pytest.raises(FileNotFoundError):
        read_stored(spark, path)


def test_a_stream_writes_a_bucket_in_one_file(spark, path, tmp_path):
    folder, schema = str(tmp_path / "rows"), "id LONG, v INT"
    for at in range(2):
        spark.range(4000).selectExpr(f"id + {at} * 2000 AS id", f"{at} AS v").write.mode("append").parquet(folder)
        counts = spark.readStream.schema(schema).parquet(folder).groupBy("id").agg(F.max("v").alias("v"))
        write_upserts(counts, path, str(tmp_path / "cp"), ["id"], buckets=16, trigger={"availableNow": True}).awaitTermination()
        files = stored_version(spark, path).files()
        assert sorted(bucket for _, bucket in files) == list(range(16))
    assert read_stored(spark, path).selectExpr("count(*)", "count(distinct id)", "sum(v)").first() == (6000, 6000, 4000)
