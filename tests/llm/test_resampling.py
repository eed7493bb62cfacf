import hashlib
import math
import re
import shutil
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from compare import duckdb_result, open_tables, spark_result

from millrace.llm import resampling as rs
from millrace.llm.queries import QUERIES, SQL


def features(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def brute(docs, target):
    s, t = (Counter(bucket(f) for text in texts for f in features(text)[1]) for texts in ([x for _, x in docs], target))
    up, down = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    found = []
    for doc_id, text in docs:
        words, fs = features(text)
        gains = [math.floor(1000 * math.log(((t[bucket(f)] + 1) * up) / ((s[bucket(f)] + 1) * down))) for f in fs]
        weight = sum(gains) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append([doc_id, len(words), len(fs), weight, score, None])
    eligible = sorted((r for r in found if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0], -r[3], -r[2]))
    for at, r in enumerate(eligible[: 25 * len(eligible) // 100]):
        r[5] = at + 1
    return sorted(map(tuple, found), key=str)


COLUMNS = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]


@pytest.fixture(scope="module")
def harsh(harsh_dir, sf_dir):
    """The harsh tables with a benchmark."""
    shutil.copy(f"{sf_dir}/benchmark.parquet", f"{harsh_dir}/benchmark.parquet")
    return harsh_dir


@pytest.mark.parametrize("tables", ["sf_dir", "harsh"])
def test_equals_sql(spark, request, tables):
    folder = request.getfixturevalue(tables)
    got = spark_result(QUERIES["op12_resampling"](spark, folder))
    assert len(got[1]) >= 200
    assert got == duckdb_result(open_tables(folder), SQL["op12_resampling"])


def test_equals_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(300).collect()]
    target = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(x,) for x in target], "text string")
    got = rs.resample(*frames).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, target)
    assert max(r.rank or 0 for r in got) > 30


def test_odd_rows(spark):
    odd = [None, "", "  ,;! ", "word", "Ünïcode ÀÉ ß 中文 42", "a" * 200_000, "\x00x\x7fy\n\tz", "same words here " * 9, "same words here " * 9]
    docs = [(i, t) for i, t in enumerate(odd)] + [(None, "null id " * 20)] * 3 + [(5, "twice the id " * 20), (5, "another text of id five " * 9)]
    docs += [(100 + i, "copied text of many words " * 5) for i in range(60)]
    target = ["same words here", None, "", "中文 ÀÉ"]
    rows = [(*d, 1, "keep") for d in docs]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _at int, _weighed string").repartition(3)
    bench = spark.createDataFrame([(x,) for x in target], "text string")
    got = rs.resample(frame, bench)
    assert sorted(map(tuple, got.select(*COLUMNS).collect()), key=str) == brute(docs, target)
    assert sorted(got.select(*frame.columns).collect(), key=str) == sorted(frame.collect(), key=str)
    kept = rs.drawn(frame, bench)
    assert kept.columns == frame.columns and kept.count() == len([r for r in brute(docs, target) if r[5]])
    assert rs.resample(frame.limit(0), bench).count() == 0
    assert rs.resample(frame, bench.limit(0)).count() == len(docs)
    assert rs.resample(frame.filter("text is null"), bench).select(*COLUMNS[1:]).distinct().count() == 1


@pytest.mark.parametrize("size", [1, 7, 40, 1 << 21])
def test_blocks_lose_no_feature(size):
    texts = ["One two  three,two one;" * 5, "", "...", "x", "" + "w" * 65 + " " + "v" * 64 + " w" * 3, "Tail of ,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,, spaces", "b c"]
    got = [Counter() for _ in texts]
    for found in rs.each_block(pa.array(texts), size):
        for owner, place, crcs in found:
            for o, p in zip(owner, place):
                got[o][int(crcs[p])] += 1
    assert got == [Counter(zlib.crc32(f.encode()) for f in features(t)[1]) for t in texts]
    assert ["".join(p for rows, pieces in rs.blocks(pa.array(texts), size) for r, p in zip(rows, pieces.to_pylist()) if r == i) for i in range(7)] == texts


def test_joined_crcs():
    left, right = [b"", b"ab", b"x" * 300], [b"", b" ", b"word", "é中".encode(), b"y" * 64]
    for a in left:
        got = rs.crc_joined(np.full(5, zlib.crc32(a)), np.array([zlib.crc32(b) for b in right]), np.array([len(b) for b in right]))
        assert got.tolist() == [zlib.crc32(a + b) for b in right]


def test_longer_runs():
    found, _ = rs.grams(np.arange(2), pa.array(["a b a b c", "d e"]), (-1, []), longest=3)
    counts = [Counter(np.asarray(crcs)[place].tolist()) for _, place, crcs in found]
    three = ["a b a", "b a b", "a b c"]
    assert counts[2] == Counter(zlib.crc32(x.encode()) for x in three)


def test_draw_prefers_the_target(spark):
    docs = [(i, ("plain filler prose with many usual words " if i % 4 else "target words speak of rivers and mountains ") * 6) for i in range(800)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([("target words speak of rivers and mountains",)] * 20, "text string")
    kept = rs.drawn(frame, bench).collect()
    assert len(kept) == 200 and sum(r.doc_id % 4 == 0 for r in kept) > 150
