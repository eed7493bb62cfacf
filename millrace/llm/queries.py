"""Registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import exact_dedup, language_id, mixing, near_dedup, packing, quality_gam, quality_rules, repeats, resampling, sharding, vector_codes, warc
from millrace.llm.base import given
from millrace.llm.token_counts import count_tokens
from millrace.session import delete_path, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op1_packing(spark, sf_dir):
    return packing.pack(given(spark, sf_dir, "documents"))


@query
def op2_repeats(spark, sf_dir):
    return repeats.remove_repeats(given(spark, sf_dir, "documents"))


@query
def op3_token_counts(spark, sf_dir):
    docs = given(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs).drop("text")


@query
def op5_quality_rules(spark, sf_dir):
    docs = given(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.quality_rules(docs, keep_text=False).select("doc_id", *quality_rules.BASE, "base_failed", "kept")


SQL["op5_quality_rules"] = quality_rules.oracle()


@query
def op4_warc(spark, sf_dir):
    pages = given(spark, sf_dir, "pages")
    folder = scratch_path(spark, "warc")
    manifest = warc.write_warc(warc.record_table(pages), folder)
    records = warc.read_warc(spark, manifest, with_content=False).filter("is_last")
    found = records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").checkpoint()
    delete_path(spark, folder)
    return found


SQL["op4_warc"] = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM q
"""


@query
def op6_quality_gam(spark, sf_dir):
    docs = given(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_gam.train(docs, given(spark, sf_dir, "labels"))
    return quality_gam.classify(docs, model).drop("text")


@query
def op7_exact_dedup(spark, sf_dir):
    docs = given(spark, sf_dir, "documents")
    return exact_dedup.exact_groups(docs).drop(*exact_dedup.PLACE)


SQL["op7_exact_dedup"] = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS n_chars,
        sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents),
g AS (
    SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id) AS keep_id,
        count(*) OVER (PARTITION BY text_sha256) AS group_size
    FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""


@query
def op8_near_dedup(spark, sf_dir):
    return near_dedup.near_groups(given(spark, sf_dir, "documents").select("doc_id", "text"))


# As many tokens as there are, no source more than twice.
MIXTURE = mixing.Target(1.0, max_repeats=2.0)


@query
def op9_mixing(spark, sf_dir):
    return mixing.mix(given(spark, sf_dir, "documents").select("doc_id", "text", "source"), MIXTURE)


SQL["op9_mixing"] = mixing.oracle(MIXTURE)


@query
def op10_language_id(spark, sf_dir):
    docs = language_id.held_out(given(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    model = language_id.train(docs.filter("not held_out"))
    return language_id.identify(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score")


# 40 shards in two regions of four racks, and the same with one more.
TREE = sharding.layout(40)
GROWN = TREE.joined(40)


@query
def op11_sharding(spark, sf_dir):
    docs = given(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_rows(docs, TREE, GROWN, keep_text=False)


SQL["op11_sharding"] = sharding.oracle(TREE, GROWN)


@query
def op12_resampling(spark, sf_dir):
    docs = given(spark, sf_dir, "documents").select("doc_id", "text")
    return resampling.resample(docs, given(spark, sf_dir, "benchmark"), keep_text=False)


SQL["op12_resampling"] = resampling.oracle()


@query
def op13_vector_codes(spark, sf_dir):
    return vector_codes.vector_codes(given(spark, sf_dir, "embeddings"))


SQL["op13_vector_codes"] = vector_codes.oracle()
