import re

import pytest
from compare import duckdb_result, open_tables, spark_result

from millrace.llm import quality_rules as q
from millrace.llm.queries import QUERIES, SQL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(5)}
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit),
        len(lines), sum(1 for c in text if re.fullmatch(r"[A-ZÀ-ÖØ-Þ]", c)), len(set(words)),
    )


def test_equals_sql(spark, sf_dir):
    columns, rows = spark_result(QUERIES["op5_quality_rules"](spark, sf_dir))
    assert (columns, rows) == duckdb_result(open_tables(sf_dir), SQL["op5_quality_rules"])


def test_features_by_brute_force(spark):
    texts = [
        None, "", " \n\t ", "a", "a b c d e", "a b c d e a b c d e f", "x x x x x x x x",
        "one two three four five six\n\none two three four five six\none\none",
        "É Ü a#b*$%&|<>\v\fz q", "p q r s t p q r s t u p q r s t", "w " * 3000,
    ]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id int, text string, n_words string")
    for r in q.text_features(docs).collect():
        assert tuple(r[c] for c in q.FEATURES) == expected(texts[r.doc_id]), texts[r.doc_id]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (1, None), (None, "")], "doc_id long, text string")
    rows = q.quality_rules(docs).collect()
    assert len(rows) == 3 and not any(r.kept for r in rows) and all(r.base_failed for r in rows)
    assert q.quality_rules(docs.limit(0)).count() == 0


def test_posterior_outvotes_a_noisy_rule(spark):
    """A rule that fires on good and bad alike loses its veto; one that fires with others keeps it."""
    noisy = (*q.RULES[:2], q.Rule("noisy", "word_chars % 5 = 0", "word_chars % 5 <> 0"))
    clean = "The quick brown fox jumps over a lazy dog while {} birds sing in the old oak tree"
    rows = [(i, clean.format("x" * (i % 10))) for i in range(300)]
    rows += [(1000 + i, clean.format("x" * (i % 10)).replace(" ", "# ").upper()) for i in range(100)]
    got = q.quality_rules(spark.createDataFrame(rows, "doc_id int, text string"), rules=noisy, steps=40).collect()
    assert all(r.kept == (r.doc_id < 1000) for r in got)


def test_agrees_with_labels(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = QUERIES["op5_quality_rules"](spark, sf_dir).join(labels, "doc_id").collect()
    good, bad = [r for r in got if r.quality == 1], [r for r in got if r.quality == 0]
    long_enough = [r for r in good if r.n_words >= 10]
    assert sum(r.kept for r in long_enough) > 0.97 * len(long_enough)
    assert sum(not r.kept for r in bad) > 0.9 * len(bad)


def test_plan_has_no_python(spark, sf_dir, plan):
    text = plan(QUERIES["op5_quality_rules"](spark, sf_dir))
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text


def test_clashing_names_are_kept(spark):
    names = ["_t", "_w", "_lines", "_h", "_s", "_at", "t_"]
    docs = spark.createDataFrame([(1, "some words " * 8, *names)], ", ".join(["doc_id long", "text string", *(f"{n} string" for n in names)]))
    got = q.quality_rules(docs)
    assert got.columns[: len(docs.columns)] == docs.columns and got.first()[: len(docs.columns)] == docs.first()
    assert got.first().n_words == 16
