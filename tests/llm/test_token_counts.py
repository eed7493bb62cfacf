import os

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import token_counts
from millrace.llm.queries import op3_token_counts
from millrace.llm.token_counts import SETTLED, count_tokens, counter

PATH = public_tokenizers.path("byte_bpe_50k.json")
os.environ["TOKENIZERS_PARALLELISM"] = "false"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_whole_tables(spark, sf_dir, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op3_token_counts(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_tokens, r.n_bytes) == (library(texts[r.doc_id]), len(texts[r.doc_id].encode()))
        assert r.over_limit == (r.n_tokens > 512)


def test_every_settled_code_point_in_several_places(library):
    for at in range(SETTLED):
        for text in (f"a{chr(at)}b", f"1{chr(at)} x", f" {chr(at)}{chr(at)}\n 's", f"{chr(at)}!"):
            assert counter(PATH).count(text) == library(text), (at, text)


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text(library, text):
    assert counter(PATH).count(text) == library(text)


def test_special_strings_are_one_token(library):
    for text in ("<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext", "  <|endoftext|>  "):
        assert counter(PATH).count(text) == library(text)


def test_table_is_proven_and_memory_is_bounded(library, monkeypatch):
    fresh = token_counts.Counter(PATH)
    assert len(fresh.whole) > 40_000
    assert all(library(piece) == 1 for piece in list(fresh)[::97])
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    texts = ["zqzqx", "qxzzk", "xkcdzz", "vvkkqq", "zqzqx"]
    assert [fresh.count(t) for t in texts] == [library(t) for t in texts]
    assert len(fresh) <= len(fresh.whole) + 3


def test_odd_rows(spark, library):
    long = "wordé \U0001f600 " * 40_000
    rows = [(1, None, 0), (1, None, 0), (2, "", 0), (None, " \n\t ", 0), (4, long, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(docs).collect())
    n = library(" \n\t ")
    assert got == [(0, 0, False)] * 3 + [(4, n, False), (len(long.encode()), library(long), True)]
    assert count_tokens(docs.limit(0)).count() == 0
