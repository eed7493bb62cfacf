import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
from compare import duckdb_result, open_tables, spark_result
from pyspark.sql import functions as F

from millrace.llm import sharding as sh
from millrace.llm.queries import GROWN, QUERIES, SQL, TREE


@pytest.mark.parametrize("tables", ["sf_dir", "harsh_dir"])
def test_equals_sql(spark, request, tables):
    folder = request.getfixturevalue(tables)
    got = spark_result(QUERIES["op11_sharding"](spark, folder))
    assert len(got[1]) >= 200
    assert got == duckdb_result(open_tables(folder), SQL["op11_sharding"])


def test_law_holds(spark, sf_dir):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op11_sharding"](spark, sf_dir).collect()
    slots = defaultdict(list)
    for r in rows:
        assert (r.size, r.text_crc32, r.law) == (len(docs[r.doc_id].encode()) + 16, zlib.crc32(docs[r.doc_id].encode()), "key")
        assert r.grown_shard in (r.shard, 40)
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert 0 < sum(r.grown_shard == 40 for r in rows) < 3 * len(rows) / 41


def descend(tree, key):
    path, children = "", tree.children()
    while path in children:
        def wait(c, key=key):
            h = int(hashlib.md5(f"{sh.SEED}|{c[0]}|{key}".encode()).hexdigest()[:13], 16)
            return -math.log((h + 0.5) / 2**52) / c[1]

        path = min(children[path], key=wait)[0]
    return path


def paths(spark, tree, n=3000):
    return {r.id: r.p for r in spark.range(n).select("id", sh.path_of("id", tree).alias("p")).collect()}


def test_equals_a_walk_down_the_tree(spark):
    tree = sh.Tree([sh.Shard(i, "ab"[i % 2], str(i % 3), 0.5 + i % 4) for i in range(17)])
    got = paths(spark, tree, 500)
    assert got == {i: descend(tree, i) for i in range(500)}


def test_weights_are_met(spark):
    tree = sh.Tree([sh.Shard(0, "a", "0", 3.0), sh.Shard(1, "a", "1", 1.0), sh.Shard(2, "b", "0", 4.0), sh.Shard(3, "b", "0", 0.0)])
    got = Counter(paths(spark, tree, 20_000).values())
    assert set(got) == {"/a/0/0", "/a/1/1", "/b/0/2"}
    assert abs(got["/a/0/0"] - 7500) < 300 and abs(got["/b/0/2"] - 10_000) < 300


def test_movement_stays_in_subtrees_whose_weights_change(spark):
    before = paths(spark, TREE)
    heavier = paths(spark, TREE.reweighted({0: 3.0}))
    moved = {(before[i], heavier[i]) for i in before if before[i] != heavier[i]}
    # Region 0 and rack 0 gain, and nothing is exchanged among the rest.
    assert moved and all(b.startswith("/0/") for _, b in moved)
    assert all(b.startswith("/0/0/") for a, b in moved if a.startswith("/0/"))
    assert all(b == "/0/0/0" for a, b in moved if a.startswith("/0/0/"))
    lighter = paths(spark, TREE.reweighted({7: 0.0}))
    assert all(a.startswith("/0/") for a, b in ((before[i], lighter[i]) for i in before) if a != b)
    assert not any(p.endswith("/7") for p in lighter.values())
    shifted = paths(spark, TREE.reweighted({0: 0.5, 1: 1.5}))
    # The rack weighs the same, so rows move within it alone.
    assert {(a.rsplit("/", 1)[0], b.rsplit("/", 1)[0]) for a, b in ((before[i], shifted[i]) for i in before) if a != b} == {("/0/0", "/0/0")}
    grown = paths(spark, GROWN)
    assert all(grown[i] == "/joined-40/0/40" for i in before if grown[i] != before[i])


def test_odd_rows_and_hot_ids(spark):
    rows = [(None, None, 5, "x")] * 400 + [(7, "same", 1, "y")] * 300 + [(i, "é" * 50_000 if i == 3 else "", i, "z") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _lot int, _start string").repartition(6)
    got = sh.shard_rows(docs, TREE, GROWN).cache()
    assert set(got.columns) == {*docs.columns, "size", "text_crc32", "law", "shard", "slot", "grown_shard"}
    assert got.count() == 1000 and sorted(got.select(*docs.columns).collect(), key=str) == sorted(docs.collect(), key=str)
    assert got.filter("doc_id is null").select("shard").distinct().count() == 1
    sizes = got.groupBy("shard").agg(F.min("slot").alias("a"), F.max("slot").alias("b"), F.countDistinct("slot").alias("n"), F.count("*").alias("c"))
    assert all((r.a, r.b, r.n) == (0, r.c - 1, r.c) for r in sizes.collect())
    assert got.filter("doc_id = 3").select("size").first()[0] == 100_016
    assert sh.shard_rows(docs.limit(0), TREE, GROWN).count() == 0


def test_bad_trees_are_refused():
    for bad in ([sh.Shard(1, "a", "0"), sh.Shard(1, "a", "1")], [sh.Shard(1, "a/b", "0")], [sh.Shard(1, "a", "0", -1.0)], [sh.Shard(1, "a", "0", 0.0)], []):
        with pytest.raises(ValueError):
            sh.Tree(bad)


def test_written_shards_come_back(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sh.write_shards(docs, TREE, f"{tmp_path}/out")
    kinds = [f"{name} {kind}" for name, kind in docs.dtypes] + ["region string", "rack string", "shard int"]
    back = spark.read.schema(", ".join(kinds)).parquet(f"{tmp_path}/out")
    expected = sh.place(docs, TREE)
    assert sorted(back.select(*docs.columns, "shard").collect(), key=str) == sorted(expected.collect(), key=str)
    one = back.filter("region = '0' and rack = '1' and shard = 6")
    assert one.count() == expected.filter("shard = 6").count() > 0
