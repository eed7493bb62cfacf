import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from compare import duckdb_result, open_tables, spark_result

from millrace.llm import vector_codes as vc
from millrace.llm.queries import QUERIES, SQL


def brute(rows, rounds=4, entries=256):
    """Plain Python over (vec_id, label, vector): every part against every entry."""
    kept = [r for r in rows if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    kept = [r for r in kept if len(r[2]) == len(kept[0][2])]
    size = len(kept[0][2])
    ends = [size * at // 4 for at in range(5)]
    parts = [[[math.floor(1024 * Fraction(x)) for x in r[2][a:b]] for r in kept] for a, b in zip(ends, ends[1:])]
    books = [[list(p) for p in part[:entries]] for part in parts]

    def nearest(book, p):
        return min((sum((x - c) ** 2 for x, c in zip(p, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for part, book in zip(parts, books):
            found = [nearest(book, p)[1] for p in part]
            for e in set(found):
                members = [p for p, f in zip(part, found) if f == e]
                book[e] = [sum(xs) // len(members) for xs in zip(*members)]
    final = [[nearest(book, part[i]) for book, part in zip(books, parts)] for i in range(len(kept))]
    codes = ["".join(f"{i:02x}" for _, i in f) for f in final]
    errors = [sum(d for d, _ in f) for f in final]
    totals = {}
    for r, e in zip(kept, errors):
        totals[r[1]] = totals.get(r[1], 0) + e
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    top = (1 << 63) - 1
    return sorted(((r[0], r[1], c, min(e, top), min(totals[r[1]], top), sha) for r, c, e in zip(kept, codes, errors)), key=str)


COLUMNS = ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
SCHEMA = "vec_id long, label int, embedding array<float>"


def run(spark, rows, schema=SCHEMA, **more):
    frame = spark.createDataFrame(rows, schema).repartition(3)
    return sorted(map(tuple, vc.vector_codes(frame, **more).select(*COLUMNS).collect()), key=str)


def test_equals_sql(spark, sf_dir):
    got = spark_result(QUERIES["op13_vector_codes"](spark, sf_dir))
    assert len(got[1]) >= 400
    assert got == duckdb_result(open_tables(sf_dir), SQL["op13_vector_codes"])


def test_equals_sql_with_holes(spark, sf_dir, tmp_path):
    from pyspark.sql import functions as F

    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    hot = given.filter("vec_id = 3").first().embedding
    broken = F.when(F.col("vec_id") % 11 == 0, F.lit(None)).when(
        F.col("vec_id") % 13 == 0, F.transform("embedding", lambda x, i: F.when(i == 5, F.lit(float("nan"))).otherwise(x))
    )
    vector = broken.when(F.col("vec_id") % 3 == 0, F.array(*(F.lit(x).cast("float") for x in hot))).otherwise(F.col("embedding"))
    label = F.when(F.col("vec_id") % 7 == 0, F.lit(None)).otherwise(F.col("label"))
    given.select("vec_id", vector.cast("array<float>").alias("embedding"), label.alias("label")).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = spark_result(QUERIES["op13_vector_codes"](spark, str(tmp_path)))
    assert 300 < len(got[1]) < 500
    assert got == duckdb_result(open_tables(str(tmp_path)), SQL["op13_vector_codes"])


@pytest.mark.parametrize("size", [8, 6, 3, 1])
def test_equals_brute_force(spark, size):
    lot = np.random.default_rng(size)
    centres = lot.normal(0, 2, (12, size))
    rows = [(i, int(i % 5) if i % 9 else None, (centres[i % 12] + lot.normal(0, 0.1, size)).astype(np.float32).tolist()) for i in range(700)]
    rows += [(1000 + i, 1, [0.5] * size) for i in range(200)]
    assert run(spark, rows, entries=64) == brute(rows, entries=64)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, 1, [1.0, 2.0, 3.0, 4.0]), (2, None, None), (3, 1, [1.0, None, 0.0, 0.0]), (4, 1, [nan, 0.0, 0.0, 0.0])]
    rows += [(5, 2, [inf, 0.0, 0.0, 0.0]), (6, 2, [-inf, 0.0, 0.0, 0.0]), (7, 2, [1.0, 2.0]), (8, 2, []), (None, None, [0.0, -0.1, 0.2, 7.0])]
    rows += [(9, 3, [1.5, 2.0, 3.0, 4.0])] * 3 + [(9, 3, [-1.5, 2.0, 3.0, 4.0])]
    assert run(spark, rows) == brute(rows) and len(brute(rows)) == 6
    assert run(spark, rows, entries=2) == brute(rows, entries=2)
    assert run(spark, []) == []
    assert run(spark, [(1, 1, None)]) == []
    assert run(spark, [(2, 1, []), (3, 1, [])]) == brute([(2, 1, []), (3, 1, [])])


def test_very_large_components(spark):
    lot = np.random.default_rng(1)
    rows = [(i, 1, (lot.normal(0, 1, 8) * 10.0 ** (i % 20)).tolist()) for i in range(150)]
    schema = "vec_id long, label int, embedding array<double>"
    assert run(spark, rows, schema, entries=16) == brute(rows, entries=16)


def test_extra_columns_are_not_read(spark):
    rows = [(i, i % 2, [float(i), 0.0, 1.0, 2.0], "x", 1) for i in range(20)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>, shared string, code int")
    got = sorted(map(tuple, vc.vector_codes(frame).select(*COLUMNS).collect()), key=str)
    assert got == brute([r[:3] for r in rows])


def test_whole_nodes_are_assigned_without_their_points():
    lot = np.random.default_rng(2)
    centres = lot.integers(-100_000, 100_000, (64, 8))
    points = (centres[lot.integers(0, 64, 4096)] + lot.integers(-20, 20, (4096, 8))).astype(np.int64)
    points = points[vc.tree_order(points, vc.LEAF)]
    book = vc.Codebook(centres)
    boxes, found = book.search(points)
    compared = sum((boxes.ends[-1][n + 1] - boxes.ends[-1][n]) * len(left) for n, left in found.unsure)
    assert sum(len(n) for _, n, _ in found.whole) > 30 and compared < 4096 * 64 / 4
    index, away = book.nearest(points)
    exact = vc.distances(points, book.entries)
    assert (index == exact.argmin(axis=1)).all() and (away == exact.min(axis=1)).all()


def test_ties_go_to_the_lower_entry():
    entries = np.array([[5, 0], [0, 0], [0, 0], [10, 0]])
    points = np.array([[0, 0]] * 70 + [[5, 0]] * 3 + [[7, 0], [8, 0], [15, 0]] * 40)
    book = vc.Codebook(entries)
    order = vc.tree_order(points, vc.LEAF)
    index, _ = book.nearest(points[order])
    assert (index == vc.distances(points[order], entries).argmin(axis=1)).all()
    sums, counts = np.zeros((4, 2), np.int64), np.zeros(4, np.int64)
    book.add_up(points[order], sums, counts)
    assert counts.tolist() == np.bincount(index, minlength=4).tolist() and counts[2] == 0
    assert sums.tolist() == [points[order][index == i].sum(axis=0).tolist() for i in range(4)]
