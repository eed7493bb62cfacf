import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from millrace.llm import repeats as rp
from millrace.llm.queries import op2_repeats


def brute_force(rows):
    """Per row (doc_id, bytes, removed, spans, digest of the rest), from a table of all 400-byte strings."""
    seen = {}
    texts = [(doc_id, (t or "").encode()) for doc_id, t in rows]
    for _, t in texts:
        for i in range(len(t) - 399):
            h = hash(t[i : i + 400])
            seen[h] = seen.get(h, 0) + 1
    out = []
    for doc_id, t in texts:
        gone = np.zeros(len(t) + 1, np.int64)
        for i in range(len(t) - 399):
            if seen[hash(t[i : i + 400])] > 1:
                gone[i] += 1
                gone[min(i + 400, len(t))] -= 1
        mask = np.cumsum(gone)[: len(t)] > 0
        spans = int(mask[0:1].sum() + (mask[1:] & ~mask[:-1]).sum()) if len(t) else 0
        rest = np.frombuffer(t, np.uint8)[~mask].tobytes()
        out.append((doc_id, len(t), int(mask.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def test_whole_table_by_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert got(op2_repeats(spark, sf_dir)) == brute_force(rows)


def harsh(seed):
    """Passages around the length, edited copies, periodic texts, overlaps within a text, exact copies."""
    rng = random.Random(seed)
    noise = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    texts = []
    for length in (390, 399, 400, 401, 420, 500, 530, 700):
        passage = noise(length).encode()[:length].decode(errors="ignore")
        for _ in range(3):
            texts.append(noise(rng.randrange(600)) + passage + noise(rng.randrange(600)))
    base = noise(4000)
    for _ in range(12):
        copy = list(base)
        for _ in range(rng.randrange(8)):
            copy[rng.randrange(len(copy))] = "X"
        texts.append("".join(copy))
        texts.append("".join(copy[rng.randrange(1500) : 1500 + rng.randrange(2500)]))
    inner = noise(450)
    texts += [inner + noise(50) + inner, inner[:420] + noise(300) + inner[30:], "ab" * 700, "a" * 401, "a" * 400, "abc" * 134, "x" * 399]
    texts += [noise(1000)] * 2 + ["", None, None, "short", "short"]
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_harsh_texts_by_brute_force(spark, seed):
    rows = harsh(seed)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n long").repartition(5)
    assert got(rp.remove_repeats(df)) == brute_force(rows)


def test_blocks_change_nothing(spark, monkeypatch):
    rng = random.Random(5)
    text = "".join(rng.choice("abcd") for _ in range(30_000)).encode()
    whole = [np.concatenate([x[k] + (x[4] if k == 0 else 0) for x in rp.stretches(text)]) for k in range(4)]
    monkeypatch.setattr(rp, "BLOCK", 1000)
    parts = [np.concatenate([x[k] + (x[4] if k == 0 else 0) for x in rp.stretches(text)]) for k in range(4)]
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))
    assert whole[1].sum() == len(text) - 399 and whole[1].max() <= rp.COVER


def test_periodic_texts_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(rp, "BLOCK", 3000)
    rng = random.Random(8)
    noise = "".join(rng.choice("abcdefgh ") for _ in range(900))
    pattern = "".join(rng.choice("abcd") for _ in range(150))
    texts = ["a" * 7000, "ab" * 3000, "x" + "ab" * 500 + "y" + "ab" * 300, "abc" * 700 + noise + "abc" * 400, pattern * 30, pattern[7:] * 3, noise + "-" * 450]
    texts += ["-" * 300 + noise[:200] + "-" * 399, "z" * 400, "z" * 401]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(rp.remove_repeats(df)) == brute_force(rows)


def test_a_long_periodic_text_is_few_rows():
    for text in (b"a" * 3_000_000, b"ab" * 1_500_000):
        kept = [rp.runs(first, count, group, content)[0] for first, count, group, content, _, _ in rp.stretches(text)]
        assert sum(map(len, kept)) < 20


def test_very_long_periodic_texts(spark, tmp_path):
    rows = [(1, "a" * 40_000_000), (2, "ab" * 20_000_000), (3, "short")]
    pq.write_table(pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]}), f"{tmp_path}/long.parquet")
    df = spark.read.parquet(f"{tmp_path}/long.parquet")
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in rp.remove_repeats(df).collect()}
    assert found == {i: (len(t), len(t) if i < 3 else 0, int(i < 3)) for i, t in rows}


def test_kept_bytes_and_odd_rows(spark):
    passage = "é" * 250
    rows = [(1, "start " + passage + " end"), (2, passage), (2, passage), (None, passage), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r.kept for r in rp.remove_repeats(df, with_kept=True).collect()), key=len)
    assert kept == [b"", b"", b"", b"", b"start  end"]
    assert rp.remove_repeats(df.limit(0)).count() == 0
