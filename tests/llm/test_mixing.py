import math

import pytest
from compare import duckdb_result, open_tables, spark_result
from pyspark.sql import functions as F

from millrace.llm import mixing as mx
from millrace.llm.queries import MIXTURE, QUERIES, SQL


@pytest.mark.parametrize("tables", ["sf_dir", "harsh_dir"])
def test_equals_sql(spark, request, tables):
    folder = request.getfixturevalue(tables)
    got = spark_result(QUERIES["op9_mixing"](spark, folder))
    assert len(got[1]) > 100
    assert got == duckdb_result(open_tables(folder), SQL["op9_mixing"])


@pytest.fixture
def docs(spark):
    sizes = {"hot": 600, "b": 200, "c": 60, "d": 40}
    rows = [(s * 1000 + i, "w " * (1 + i % 7), name, 1) for s, (name, n) in enumerate(sizes.items()) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, epoch int")


def shares(df):
    rows = df.groupBy("source").agg(F.sum("n_tokens").alias("t"), F.countDistinct("doc_id").alias("n")).collect()
    return {r.source: (r.t, r.n) for r in rows}


def test_limit_on_repeats_is_met_and_not_more(docs, monkeypatch):
    monkeypatch.setattr(mx, "BLOCK_TOKENS", 50)
    there = {r.source: r.t for r in mx.token_sizes(docs).groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()}
    total = sum(there.values())
    used = mx.mix(docs, mx.Target(1.0, max_repeats=2.0))
    got = shares(used)
    repeats = {s: got[s][0] / there[s] for s in there}
    assert max(repeats.values()) <= 2.0 and max(repeats.values()) > 1.9
    assert total - 4 * 7 <= sum(t for t, _ in got.values()) <= total
    assert repeats["d"] > repeats["c"] > repeats["b"] > repeats["hot"]
    per_epoch = used.groupBy("source", "epoch").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("k")).collect()
    assert all(r.n == r.k for r in per_epoch)
    whole = used.filter("source = 'd' and epoch = 0")
    assert whole.count() == 40
    again = used.filter("source = 'd' and epoch = 1").join(whole.withColumnRenamed("doc_order", "o"), "doc_id")
    assert again.filter("o <> doc_order").count() > 0


def test_entropy_is_met(docs):
    at = mx.exponent(mx.token_sizes(docs).groupBy("source").agg(F.sum("n_tokens").alias("t")), mx.Target(min_entropy=1.2))
    t = [r.t for r in mx.token_sizes(docs).groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()]
    w = [x**at for x in t]
    entropy = -sum(x / sum(w) * math.log(x / sum(w)) for x in w)
    assert 1.2 <= entropy < 1.2001


def test_rows_keep_their_columns_and_repeat(docs):
    kept = mx.mix_rows(docs, mx.Target(0.9, max_repeats=1.0))
    assert kept.columns == docs.columns
    counts = {r.source: r["count"] for r in kept.groupBy("source").count().collect()}
    assert kept.count() == kept.select("doc_id").distinct().count()
    assert counts["d"] >= 39 and counts["hot"] < 600
    twice = mx.mix_rows(docs, mx.Target(1.0, max_repeats=2.0)).filter("source = 'd'")
    assert twice.count() > twice.select("doc_id").distinct().count() == 40


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "a b", None), (3, "", "x"), (None, "a", "y"), (5, "w " * 100_000, "y"), (5, "w " * 100_000, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mx.mix(docs, mx.Target(1.0, max_repeats=1.0)).collect()
    assert sorted((r.source, r.n_tokens) for r in got if r.n_tokens) == [("", 2), ("y", 1), ("y", 100_000), ("y", 100_000)]
    assert mx.mix(docs.limit(0), MIXTURE).count() == 0
    assert mx.mix(docs.filter("text is null"), MIXTURE).count() == 0
    with pytest.raises(ValueError):
        mx.Target()


def test_rows_without_an_id_are_kept(spark):
    rows = [(None, f"t{i} " * 5, "a", i) for i in range(6)] + [(None, "same words", "a", 9)] * 3 + [(0, "zero id", "a", 1), (1, "b " * 9, "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n int")
    got = sorted(map(tuple, mx.mix_rows(docs, mx.Target(1.0, max_repeats=1.0)).collect()), key=str)
    assert got == sorted(rows, key=str)
    uses = [(r.doc_id, r.n_tokens) for r in mx.mix(docs, mx.Target(1.0, max_repeats=2.0)).collect() if r.doc_id is None]
    twice = mx.mix_rows(docs, mx.Target(1.0, max_repeats=2.0)).filter("doc_id is null").collect()
    assert sorted(n for _, n in uses) == sorted(len(r.text.split()) for r in twice)
    cut = mx.mix_rows(docs.filter("doc_id is null"), mx.Target(0.5, max_repeats=1.0)).collect()
    assert 0 < sum(len(r.text.split()) for r in cut) <= 18


def test_plan_has_no_python(spark, sf_dir, plan):
    text = plan(QUERIES["op9_mixing"](spark, sf_dir))
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text


def test_rows_that_repeat_an_id_are_held_to_the_budget(spark):
    rows = [(7, "w " * 4, "a", i) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _row int").repartition(4)
    half = mx.mix_rows(docs, mx.Target(0.5, max_repeats=1.0))
    assert half.columns == docs.columns and half.count() == half.distinct().count() == 50
    assert mx.mix_rows(docs, mx.Target(1.0, max_repeats=1.0)).count() == 100
    other = spark.createDataFrame([(7, "x " * 40, "b", 1, 2), (7, "y y", "b", 3, 4)], "doc_id long, text string, source string, _id int, _uses int")
    got = mx.mix_rows(other, mx.Target(1.0, max_repeats=1.0))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, other.collect()))
