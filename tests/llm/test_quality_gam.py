import zlib

import numpy as np

from millrace.llm import quality_gam as qg
from millrace.llm.queries import op6_quality_gam


def test_held_out_accuracy_and_whole_table(spark, sf_dir):
    ids = [r.doc_id for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = op6_quality_gam(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(ids)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.93 * len(held)
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)


def test_features_of_a_text():
    got = dict(zip(qg.FEATURES, qg.features("Ab c! ab\nc 12"), strict=True))
    assert got["bytes"] == np.log1p(13) and got["words"] == np.log1p(5)
    assert got["capitals"] == 1 / 13 and got["digits"] == 2 / 13 and got["exclaims"] == 1 / 13 and got["breaks"] == 1 / 13
    assert got["distinct_words"] == 1.0 and got["distinct_lines"] == 1.0
    assert all(v == 0 for v in qg.features(""))


def test_best_cuts():
    gain = np.array([1.0, 1, -1, -1, 3, 3])
    step = qg.leaves(gain, np.full(6, 10.0))
    assert step[0] == step[1] > 0 > step[2] == step[3] and step[4] == step[5] > step[0]


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    single, paired = qg.fit(x, y, pair_rounds=0), qg.fit(x, y)
    assert ((single.score(x) > 0.5) == y).mean() < 0.7 < 0.95 < ((paired.score(x) > 0.5) == y).mean()
    assert (0, 1) in paired.pairs


def test_odd_rows(spark):
    rows = [(None, None, 1), (1, "", 1), (1, "", 1), (2, "wörd " * 200_000, 1)] + [(i, f"good text {i}", 1) for i in range(10, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, 1) for i in range(60)] + [(3, None), (None, 0)], "doc_id long, quality int")
    model = qg.train(docs, labels)
    got = qg.classify(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    blank = qg.train(docs, labels.limit(0))
    assert {r.score for r in qg.classify(docs, blank).collect()} == {0.5}
    assert qg.classify(docs.limit(0), model).count() == 0
