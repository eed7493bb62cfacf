import hashlib
import re

import pytest
from test_near_dedup import brute_force
from test_packing import check
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from millrace.llm import packing, quality_rules
from millrace.session import scratch_path


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """What goes into and comes out of each stage, run one by one as `run` does."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "stage")
        before, docs = docs, stage(spark, docs, sf_dir)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, before, docs))
    return {name: (before, after) for name, before, after in out}


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_return_documents(steps, spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    assert [n for n, _ in corpus_pipeline.STAGES] == list(steps) and len(steps) == 5
    for name, (before, after) in steps.items():
        assert before.schema == schema
        if name != "packing":
            assert after.schema == schema and 0 < after.count() <= before.count()


def test_quality(steps, spark, sf_dir):
    before, after = steps["quality_rules"]
    assert ids(after) == {r.doc_id for r in quality_rules.quality_rules(before).filter("kept").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = ids(after)
    assert sum(labels.get(i, 1) == 0 for i in kept) <= 0.02 * len(kept)


def test_exact(steps):
    before, after = steps["exact_dedup"]
    best = {}
    for r in before.collect():
        key = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", r.text).encode()).digest()
        best[key] = min(best.get(key, (1, 0)), (-len(r.text), r.doc_id))
    assert ids(after) == {doc_id for _, doc_id in best.values()}


def test_near(steps):
    before, after = steps["near_dedup"]
    assert ids(after) == {c for _, _, c in brute_force([(r.doc_id, r.text) for r in before.collect()])}


def test_mixing(steps):
    before, after = steps["mixing"]
    assert ids(after) < ids(before)
    count = lambda df: {r.source: r["count"] for r in df.groupBy("source").count().collect()}
    was, now = count(before), count(after)
    assert sum(now.values()) == len(ids(after))
    assert all(now[s] >= 0.5 * was[s] for s in was)


def test_packing(steps):
    before, after = steps["packing"]
    tokenizer = Tokenizer.from_file(packing.word_ids.__wrapped__ and packing.os.path.join(packing.TOKENIZERS, "word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in before.collect()}
    check(after.collect(), texts, lambda t: [*tokenizer.encode(t, add_special_tokens=False).ids, 2])


def test_run_is_the_stages(steps, spark, sf_dir):
    got = contract.queries()["pipeline"](spark, sf_dir)
    pieces = lambda df: sorted((r.doc_id, r.doc_tokens) for r in df.select("doc_id", "doc_tokens").distinct().collect())
    assert pieces(got) == pieces(steps["packing"][1])


def test_odd_documents(spark, sf_dir):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "x " * 30, "en", "a", 60)]
    rows += [(i, f"some plain text number {i} about nothing much at all, with words and more words {i * 7}", "en", "b", 80) for i in range(10, 60)]
    docs = spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, _t string")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
        docs = stage(spark, docs, sf_dir)
    assert docs.count() > 0
