import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import top_k
from millrace.session import path_exists, release_scratch, scratch_path
from millrace.sinks import (
    append_table,
    bucket_count,
    finished_batches,
    read_snapshot,
    register_external,
    replace_table,
    to_messages,
    write_bucketed,
    write_csv_report,
    write_partitioned,
)
from millrace.sources import read_table


def test_append_and_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    append_table(spark.range(3), path)
    append_table(spark.range(2), path)
    assert spark.read.parquet(path).count() == 5
    replace_table(spark.range(1), path)
    assert spark.read.parquet(path).count() == 1


def test_dynamic_overwrite_keeps_other_partitions_and_prunes(spark, tmp_path, plan):
    path = str(tmp_path / "t")
    df = spark.range(30).withColumn("p", (F.col("id") % 3).cast("int"))
    write_partitioned(df, path, ["p"])
    write_partitioned(df.filter("id = 1"), path, ["p"])
    back = spark.read.parquet(path)
    assert sorted((r.p, r["count"]) for r in back.groupBy("p").count().collect()) == [(0, 10), (1, 1), (2, 10)]
    assert "PartitionFilters: [isnotnull(p" in plan(back.filter("p = 2"))


def test_bucketed_table_needs_no_exchange(spark, tmp_path, plan):
    df = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
    table = write_bucketed(df, "bucketed_ids", "k", str(tmp_path / "b"), n=4)
    grouped = table.groupBy("k").count()
    assert "Exchange" not in plan(grouped)
    assert grouped.count() == 50 and table.count() == 1000
    joined = table.alias("a").join(table.alias("b"), "k").hint("merge")
    assert "Exchange hashpartitioning" not in plan(joined)


def test_buckets_follow_the_size_and_a_hot_one_is_split(spark, tmp_path, plan, monkeypatch):
    from millrace.sinks import tables

    df = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
    assert bucket_count(df) == 1
    monkeypatch.setattr(tables, "plan_bytes", lambda _: 10 << 40)
    assert bucket_count(df) == 20_000
    monkeypatch.setattr(tables, "plan_bytes", lambda _: 1 << 30)
    assert bucket_count(df) == 4
    plain = write_bucketed(df, "hot_ids", "k", str(tmp_path / "b"), largest=100)
    assert "Exchange" in plan(plain.groupBy("k").count()) and plain.count() == 1000


def test_rows_of_a_narrow_table_that_compresses_well_fill_buckets(spark, tmp_path, monkeypatch):
    from millrace.sinks import tables

    monkeypatch.setattr(tables, "BUCKET_ROWS", 1000)
    spark.range(10_500).select((F.col("id") % 5000).alias("k"), F.lit(1).alias("v")).write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    assert tables.plan_bytes(df) < tables.BUCKET_BYTES and bucket_count(df) == 11
    table = write_bucketed(df, "counted_buckets", "k", str(tmp_path / "b"))
    assert table.count() == 10_500
    held = table.groupBy("k").count().groupBy(F.spark_partition_id().alias("p")).agg(F.sum("count").alias("n")).collect()
    assert len(held) == 11 and max(r.n for r in held) < 2000


def test_a_join_of_bucketed_tables_takes_its_buckets_from_the_larger(spark, sf_dir, monkeypatch):
    from millrace.plans.batch_queries import BATCH
    from millrace.sinks import tables

    seen, write = [], tables.write_bucketed
    monkeypatch.setattr(tables, "BUCKET_ROWS", 10_000)
    monkeypatch.setattr("millrace.plans.batch_queries.write_bucketed", lambda *a, n, **b: seen.append(n) or write(*a, n=n, **b))
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    assert sum(r.line_count for r in BATCH["bucketed_join"](spark, sf_dir).collect()) == lines
    assert seen[1] == 2 * seen[0] >= lines / 10_000 > 2


def test_bucketed_tables_join_without_exchange(spark, tmp_path, plan):
    left = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
    right = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    a = write_bucketed(left, "many_buckets", "k", str(tmp_path / "a"), n=8)
    b = write_bucketed(right, "few_buckets", "k", str(tmp_path / "b"), n=4)
    same = a.join(write_bucketed(right, "same_buckets", "k", str(tmp_path / "c"), n=8).hint("merge"), "k")
    multiple = a.join(b.hint("merge"), "k")
    for joined in (same, multiple):
        assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
        assert joined.agg(F.count("*"), F.sum("w")).first() == (1000, 20 * sum(range(0, 100, 2)))


def test_partition_values_come_back_as_written(spark, tmp_path):
    df = spark.createDataFrame([(1, "01"), (2, "1"), (3, None)], "id INT, p STRING")
    write_partitioned(df, str(tmp_path / "p"), ["p"])
    back = read_table(spark, str(tmp_path / "p"), df.schema)
    assert sorted(map(tuple, back.collect())) == [(1, "01"), (2, "1"), (3, None)]
    with pytest.raises(Exception, match="empty text"):
        write_partitioned(spark.createDataFrame([(1, "")], "id INT, p STRING"), str(tmp_path / "q"), ["p"])


def test_unfinished_batches_are_not_read(spark, tmp_path):
    for batch in range(2):
        spark.range(5).write.parquet(f"{tmp_path}/batch_id={batch}")
    (tmp_path / "batch_id=1" / "_SUCCESS").unlink()
    assert finished_batches(spark, str(tmp_path)).count() == 5
    assert read_snapshot(spark, str(tmp_path)).count() == 5
    (tmp_path / "batch_id=0" / "_SUCCESS").unlink()
    with pytest.raises(FileNotFoundError):
        finished_batches(spark, str(tmp_path))


def test_scratch_is_released_when_asked(spark):
    path = scratch_path(spark, "t")
    spark.range(3).write.parquet(path)
    assert path_exists(spark, path) and release_scratch(spark) >= 1
    assert not path_exists(spark, path)


def test_nothing_stays_cached(spark, sf_dir):
    from millrace.plans.batch_queries import BATCH

    spark.catalog.clearCache()
    for name in ("cached_key_counts", "consecutive_breaches"):
        BATCH[name](spark, sf_dir).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_external_table_outlives_its_name(spark, tmp_path):
    path = str(tmp_path / "x")
    replace_table(spark.range(4), path)
    assert register_external(spark, "outside", path).count() == 4
    spark.sql("DROP TABLE outside")
    assert spark.read.parquet(path).count() == 4


def test_csv_report(spark, tmp_path):
    path = tmp_path / "r"
    counts = spark.createDataFrame([("a", 1), ("b", 2), ("c", 0)], "Service STRING, Occurrences BIGINT")
    write_csv_report(top_k(counts, [F.desc("Occurrences")], 2), str(path))
    (part,) = path.glob("*.csv")
    assert part.read_text() == "Service,Occurrences\nb,2\na,1\n"


def test_null_fields_are_left_out_of_messages(spark):
    df = spark.createDataFrame([(1, None, "s")], "id INT, a DOUBLE, b STRING")
    row = to_messages(df, "id", ["a", "b"]).first()
    assert row.key == "1" and json.loads(row.value) == {"b": "s"}
