import hashlib
import re

from compare import duckdb_result, open_tables, spark_result
from pyspark.sql import functions as F

from millrace.llm import exact_dedup as ed
from millrace.llm.queries import QUERIES, SQL

ROWS = [
    (1, "a b c", 0), (2, "abc", 0), (3, "a  b\tc\n", 0), (4, " a b c", 0), (5, None, 0), (6, "", 0), (7, " \n", 0), (8, "x", 0),
    (8, "x", 0), (None, "x", 0), (None, "long only null", 0), (9, "é z", 0), (10, "éz", 0), (11, "big " * 50_000, 0),
    (12, "big" * 50_000, 0),
]


def expected(rows):
    groups = {}
    for doc_id, text, _ in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(key, []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = []
    for doc_id, text, _ in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        keep = min(groups[key])[3]
        out.append((doc_id, keep, len(groups[key]), hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=str)


def frame(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, digest int")


def test_equals_sql(spark, sf_dir):
    result = spark_result(QUERIES["op7_exact_dedup"](spark, sf_dir))
    assert result == duckdb_result(open_tables(sf_dir), SQL["op7_exact_dedup"])


def test_groups_by_brute_force(spark):
    df = ed.exact_groups(frame(spark).repartition(5))
    assert got(df) == expected(ROWS)
    assert df.filter("kept").count() == len({r[3] for r in expected(ROWS)})


def test_colliding_digests_are_told_apart_by_bytes(spark):
    df = ed.exact_groups(frame(spark).repartition(5), digest=lambda c: F.substring(ed.sha256(c), 1, 1))
    assert got(df) == expected(ROWS)
    assert df.filter("kept").count() == len({r[3] for r in expected(ROWS)})


def test_rows_that_stay_keep_their_columns(spark):
    kept = ed.exact_dedup(frame(spark))
    assert kept.columns == ["doc_id", "text", "digest"]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, 7, 8, None, 9, 10, 11], key=str)
    assert ed.exact_dedup(frame(spark).limit(0)).count() == 0
    assert ed.exact_groups(frame(spark).limit(0)).count() == 0


def test_clashing_names_are_kept(spark):
    rows = [(1, "a b", "p", 1), (2, "ab", "q", 2), (3, "c", "r", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __path string, __row int")
    before = spark.conf.get("spark.sql.streaming.stateStore.unloadOnCommit", None)
    kept = ed.exact_dedup(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]
    assert spark.conf.get("spark.sql.streaming.stateStore.unloadOnCommit", None) == before
