"""Importance resampling towards a target distribution, with hashed n-gram features.

A text is the bag of its runs of one or two words, each folded into a bucket by its CRC-32. How much likelier a bucket
is in the target than in the corpus is its gain; a document's weight is the mean gain of its features, and adding Gumbel
noise that depends on its identifier alone turns the highest scores into a draw without replacement.

Both passes run on Arrow kernels, a block of text at a time: `ascii_lower`, `split_pattern_regex`, `list_flatten` and
`dictionary_encode` make words into numbers; the numbers next to each other form n-grams, of which only the distinct ones
of a block are hashed; `take` brings their buckets' gains back to the places they occur in, and the gains are added up
by segments, one per document.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import CRC_STEPS, crc32_sql, free_names, ready, whole_text
from millrace.operators import numbered
from millrace.session import materialise

BUCKETS = 10_000
LONGEST = 2
SEED = 7
PERCENT = 25
LEAST_WORDS = 20
# All that is neither a digit, a small letter nor beyond ASCII lies between words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CUT = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
# Characters of text that are taken apart at a time.
BLOCK = 1 << 21


def _shifts(longest: int) -> np.ndarray:
    """What 0 to `longest` bytes of zeros after it make of each byte of a CRC-32, as [length, byte's place, value]."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    tables = []
    for _ in range(longest + 1):
        table = np.zeros((4, 256), np.uint32)
        for at, image in enumerate(bits):
            table[at // 8, (np.arange(256) >> (at % 8)) & 1 == 1] ^= image
        tables.append(table)
        for _ in range(8):
            bits = (bits >> np.uint32(1)) ^ np.where(bits & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return np.stack(tables)


# Words of more bytes than this are hashed one by one.
SHIFTED = 64
SHIFTS = _shifts(SHIFTED)
BLANK = zlib.crc32(b" ")


def crc_joined(left: np.ndarray, right: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of two texts one after the other from that of each and the second's bytes, at most SHIFTED."""
    parts = [SHIFTS[size, at, (left >> (8 * at)) & 255] for at in range(4)]
    return (parts[0] ^ parts[1] ^ parts[2] ^ parts[3]).astype(np.int64) ^ right


def blocks(texts: pa.Array, size: int = BLOCK) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Whole texts as blocks of pieces with their text's number; a text over `size` is cut between two words."""
    rows, pieces, held = [], [], 0
    for row, value in enumerate(texts):
        text, start = value.as_py(), 0
        while start < len(text):
            cut = CUT.search(text, start + size - held) if len(text) - start > size - held else None
            end = cut.end() if cut else len(text)
            rows.append(row)
            pieces.append(text[start:end])
            held += end - start
            start = end
            if held >= size:
                yield np.array(rows), pa.array(pieces, pa.string())
                rows, pieces, held = [], [], 0
    if pieces:
        yield np.array(rows), pa.array(pieces, pa.string())


def _crcs(words: pa.Array) -> np.ndarray:
    """CRC-32 of each text's bytes, read where they lie."""
    _, starts, data = words.buffers()
    at = np.frombuffer(starts, np.int32)[words.offset : words.offset + len(words) + 1].tolist() if len(words) else [0]
    octets = memoryview(data) if data is not None else b""
    return np.fromiter((zlib.crc32(octets[a:b]) for a, b in zip(at, at[1:])), np.int64, len(words))


def grams(rows: np.ndarray, pieces: pa.Array, before: tuple[int, list[str]], longest: int = LONGEST):
    """n-grams of a block, and what the next block needs of it.

    For each length: the text's number at each place, the place's distinct n-gram, and the CRC-32 of each distinct
    n-gram. `before` has the last words of the text that the block goes on with, whose own n-grams were counted.
    """
    split = pc.split_pattern_regex(pc.ascii_lower(pieces), BETWEEN)
    words, parents = pc.list_flatten(split), pc.list_parent_indices(split)
    there = pc.greater(pc.binary_length(words), 0)
    owner = rows[parents.filter(there).to_numpy()]
    words = words.filter(there)
    carried = before[1] if before[0] == rows[0] else []
    if carried:
        words = pa.concat_arrays([pa.array(carried, pa.string()), words])
        owner = np.concatenate([np.full(len(carried), rows[0]), owner])
    encoded = words.dictionary_encode()
    number, spelt = encoded.indices.to_numpy().astype(np.int64), encoded.dictionary
    sizes, alone = pc.binary_length(spelt).to_numpy().astype(np.int64), _crcs(spelt)
    found, place, crcs = [], number, alone
    for n in range(1, longest + 1):
        if n > 1:
            whole = owner[n - 1 :] == owner[: len(owner) - n + 1]
            pairs = place[: max(len(owner) - n + 1, 0)] * max(len(spelt), 1) + number[n - 1 :]
            # Places whose n words are not of one text get a number of their own that nothing reads.
            distinct, place = np.unique(np.where(whole, pairs, -1), return_inverse=True)
            head, word = np.divmod(np.maximum(distinct, 0), max(len(spelt), 1))
            spaced = crc_joined(crcs[head], BLANK, 1) if len(head) else head
            crcs = crc_joined(spaced, alone[word], np.minimum(sizes[word], SHIFTED)) if len(head) else head
            for i in np.flatnonzero(sizes[word] > SHIFTED):
                crcs[i] = zlib.crc32(spelt[word[i]].as_buffer(), int(spaced[i]))
        else:
            whole = np.ones(len(owner), bool)
        new = whole & (np.arange(len(whole)) + n > len(carried))
        found.append((owner[: len(whole)][new], place[new], crcs))
    last = rows[-1]
    tail = np.arange(max(len(number) - longest + 1, 0), len(number))
    return found, (last, spelt.take(pa.array(number[tail[owner[tail] == last]])).to_pylist())


def each_block(texts: pa.Array, size: int = BLOCK) -> Iterator[list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """n-grams of all texts by blocks. A batch that is a block at most is taken as it is."""
    before: tuple[int, list[str]] = (-1, [])
    if 0 < texts.nbytes <= size:
        yield grams(np.arange(len(texts)), texts, before)[0]
        return
    for rows, pieces in blocks(texts, size):
        found, before = grams(rows, pieces, before)
        yield found


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """`bucket` and `n`, the features of all whole texts in it. A task sends one row per bucket at most."""
    ready(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for found in each_block(batch.column(0)):
                for _, place, crcs in found:
                    np.add.at(total, crcs % buckets, np.bincount(place, minlength=len(crcs)))
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(total[there], pa.int64())], ["bucket", "n"])

    counts = docs.select(whole_text(text).alias("text")).mapInArrow(count, "bucket long, n long")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket from the counts of corpus and target, as one number per bucket."""
    both = corpus.withColumn("t", F.lit(0)).unionByName(target.select("bucket", F.lit(0).alias("n"), F.col("n").alias("t")))
    # At most `buckets` rows, whatever the size of the corpus.
    rows = both.groupBy("bucket").agg(F.sum("n").alias("s"), F.sum("t").alias("t")).collect()
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for r in rows:
        s[r.bucket], t[r.bucket] = r.s, r.t
    up, down = int(s.sum()) + buckets, int(t.sum()) + buckets
    ratio = [(float(a + 1) * float(up)) / (float(b + 1) * float(down)) for a, b in zip(t.tolist(), s.tolist(), strict=True)]
    return np.array([math.floor(1000.0 * math.log(r)) for r in ratio], np.int64)


def weighed(docs: DataFrame, gains: np.ndarray, text: str = "text") -> DataFrame:
    """`docs` with `n_words`, `n_features` and `weight`, the floored mean gain of the text's features (none: 0)."""
    ready(docs.sparkSession)
    (name,) = free_names(docs, "_weighed")

    @F.arrow_udf("struct<n_words:long,n_features:long,weight:long>")
    def weigh(texts: pa.Array) -> pa.Array:
        n, total = np.zeros((LONGEST, len(texts)), np.int64), np.zeros(len(texts), np.int64)
        for found in each_block(texts):
            for at, (owner, place, crcs) in enumerate(found):
                if not len(owner):
                    continue
                first = np.flatnonzero(np.diff(owner, prepend=-1))
                gain = pa.array(gains).take(pa.array(crcs % len(gains))).take(pa.array(place)).to_numpy()
                total[owner[first]] += np.add.reduceat(gain, first)
                n[at][owner[first]] += np.diff(first, append=len(owner))
        features = n.sum(axis=0)
        parts = [n[0], features, total // np.maximum(features, 1)]
        return pa.StructArray.from_arrays([pa.array(p) for p in parts], ["n_words", "n_features", "weight"])

    found = docs.withColumn(name, weigh(whole_text(text)))
    return found.withColumns({c: F.col(f"{name}.{c}") for c in ("n_words", "n_features", "weight")}).drop(name)


def noise(key: str = "doc_id", seed: int = SEED) -> Column:
    """Gumbel noise in thousandths from a digest of seed and key; a null key counts as empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    keep_text: bool = True,
) -> DataFrame:
    """`docs` with `n_words`, `n_features`, `weight`, `score` and `rank`.

    The corpus is `docs`, whole, the target the texts of `target`, whole. Of the documents with at least `least_words`
    words, `percent` of a hundred are drawn by score, then smaller doc_id; `rank` counts them from 1 and is null for the
    rest. Null texts are empty: no features, weight 0, never drawn. Rows that repeat an id have the same noise, and rank
    by weight, then features; null ids come first. Empty tables give no gains and no rows. Columns of the new names are
    replaced, others stay.
    """
    gains = bucket_gains(bucket_counts(docs), bucket_counts(target))
    scored = weighed(docs, gains)
    scored = scored.withColumn("score", F.col("weight") + noise())
    scored = materialise(scored if keep_text else scored.drop("text"))
    eligible = F.col("n_words") >= least_words
    drawn = scored.agg(F.count_if(eligible)).first()[0] * percent // 100
    at, salt = free_names(scored, "_at", "_salt")
    # Scores lie close together, so ids deal equal ones over the ranges, and the salt deals repeated rows.
    order = [F.desc("score"), F.col("doc_id").asc_nulls_first(), F.desc("weight"), F.desc("n_features"), F.col(salt)]
    ranked = numbered(scored.filter(eligible).withColumn(salt, F.monotonically_increasing_id()), order, at)
    ranked = ranked.withColumn("rank", F.when(F.col(at) <= drawn, F.col(at))).drop(at, salt)
    rest = scored.filter(~eligible).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest)


def drawn(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """The documents that `resample` draws, with the columns of `docs`."""
    marked = resample(docs, target, percent, least_words)
    return marked.filter(F.col("rank").isNotNull()).select(*docs.columns)


def oracle() -> str:
    """The same as DuckDB SQL."""
    words = r"regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), '[^ ]+')"
    return f"""
WITH RECURSIVE {CRC_STEPS},
d AS (SELECT row_number() OVER () AS row, doc_id, {words} AS w FROM documents),
b AS (SELECT {words} AS w FROM benchmark),
f AS (
    SELECT row, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature FROM d),
g AS (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature FROM b),
k AS (
    SELECT feature, {crc32_sql("feature")} % {BUCKETS} AS bucket
    FROM (SELECT feature FROM f UNION SELECT feature FROM g), crc_steps),
s AS (SELECT bucket, count(*) AS n FROM f JOIN k USING (feature) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM g JOIN k USING (feature) GROUP BY bucket),
totals AS (SELECT coalesce((SELECT sum(n) FROM s), 0)::DOUBLE + {BUCKETS} AS s, coalesce((SELECT sum(n) FROM t), 0)::DOUBLE + {BUCKETS} AS t),
gains AS (
    SELECT bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * totals.s) / ((s.n + 1)::DOUBLE * totals.t)))::BIGINT AS gain
    FROM s LEFT JOIN t USING (bucket), totals),
weights AS (
    SELECT row, count(*) AS n_features, sum(gain)::BIGINT AS total FROM f JOIN k USING (feature) JOIN gains USING (bucket) GROUP BY row),
scored AS (
    SELECT row, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
        CASE WHEN n_features > 0 THEN (total - (total % n_features + n_features) % n_features) // n_features ELSE 0 END AS weight,
        ('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE AS h
    FROM d LEFT JOIN weights USING (row)),
final AS (
    SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score, n_words >= {LEAST_WORDS} AS eligible FROM scored),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY score DESC, doc_id NULLS FIRST, weight DESC, n_features DESC) AS place,
        {PERCENT} * count(*) OVER (PARTITION BY eligible) // 100 AS n_drawn
    FROM final)
SELECT doc_id, n_words, n_features, weight, score, CASE WHEN eligible AND place <= n_drawn THEN place END AS rank FROM ranked
"""
