"""Removal of long repeats by fingerprints at a difference cover chosen by content, cut off at the length that matters.

Only the first LENGTH bytes of suffixes are ever compared, so suffixes need telling apart no further than that.

1. Difference cover. Positions are sampled by content: one is in the sample where the leftmost least 16-byte name of
   the COVER starts from it on is not that of the next position. Equal strings are sampled alike, and any start has
   a sampled one at most COVER - 1 after it; so do any two equal strings, at the same offset.
2. Names. Three 16-byte names make the name of 48 bytes, three of those that of 144, and three of those that of
   LENGTH: the triples of the algorithm, recursed on. Names are 64-bit fingerprints and not ranks, so that a level
   needs no sort of the whole corpus; equal triples have equal names everywhere.
3. Sampled suffixes are grouped by the name of their first LENGTH - COVER bytes, which every start before them shares.
   A group of one has no repeat. In the others, whole stretches of starts that occur twice are settled.
4. The remaining suffixes, starts in stretches that differ from all others of their group, are merged in: they are
   compared with each other and with one stretch of each kind by their LENGTH-byte names.

A text that goes on with a short period is sampled once a period; equal stretches that follow each other are one row
with the number of times. What is held to be equal agrees in two 64-bit fingerprints, of the start itself and of its
group; texts are told apart by 96 bits and their length.

Names are counted with partial aggregation and joined back through exchanges that AQE can split, so a string that a
third of all documents share is gathered nowhere.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import Shelf, whole_text
from millrace.plans.sizing import sized_join

LENGTH = 400
COVER = 128
# Bytes of a text that are named at a time, and the bytes around them that their names depend on.
BLOCK = 1 << 20
BEFORE, AFTER = 2 * COVER, LENGTH + 2 * COVER

LETTERS = np.random.default_rng(2).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15


def triple(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The name of three names."""
    x = a * np.uint64(0xD6E8FEB86659FD93) + b
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xA0761D6478BD642F) + c
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xE7037ED1A0B428DB)
    return x ^ (x >> np.uint64(32))


def names(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the 16 and of the 144 bytes from each position on."""
    x = LETTERS[data]
    for step in (1, 2, 4, 8):
        x = x[:-step] * np.uint64(pow(BASE, step, 1 << 64)) + x[step:]
    x = triple(x, x, x)
    y = triple(x[:-32], x[16:-16], x[32:])
    return x, triple(y[:-96], y[48:-48], y[96:])


def sampled(short: np.ndarray) -> np.ndarray:
    """Positions of the difference cover."""
    least = (short & ~np.uint64(0xFFFFFFFF)) | np.arange(len(short), dtype=np.uint64)
    step = 1
    while step < COVER:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    at = least & np.uint64(0xFFFFFFFF)
    return np.flatnonzero(at[1:] != at[:-1])


def stretches(text: bytes):
    """Block by block: for each stretch its first start, number of starts, group and content; and a naming function.

    A stretch is the starts after a sampled position up to the next one; the last may be cut by the end of the text.
    """
    n = len(text)
    for start in range(0, n if n >= LENGTH else 0, BLOCK):
        low = max(0, start - BEFORE)
        data = np.frombuffer(text, np.uint8, min(n, start + BLOCK + AFTER) - low, low)
        if len(data) < LENGTH:
            continue
        short, middle = names(data)
        # Short names end before the text does; the last starts have samples by the guarantee all the same.
        r = sampled(short)
        r = r[r + low <= n - (LENGTH - COVER)]
        first = np.concatenate([[0 if low == 0 else -1], r[:-1] + 1])[: len(r)]
        count = np.minimum(r, n - LENGTH - low) - first + 1
        use = (first >= 0) & (count > 0) & (r + low >= start) & (r + low < start + BLOCK)
        r, first, count = r[use], first[use], count[use]

        def whole(at: np.ndarray, middle=middle) -> np.ndarray:
            return triple(middle[at], middle[at + 128], middle[at + 256])

        group = triple(middle[r], middle[r + LENGTH - COVER - 144], np.uint64(LENGTH - COVER) + np.zeros(len(r), np.uint64))
        content = triple(whole(first), whole(first + count - 1), count.astype(np.uint64))
        yield first, count, group, content, low, whole


def runs(first: np.ndarray, count: np.ndarray, group: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of stretches that follow each other and are equal, the first one's index, and how many they are."""
    follows = first[1:] == first[:-1] + count[:-1]
    for x in (count, group, content):
        follows &= x[1:] == x[:-1]
    at = np.flatnonzero(np.concatenate([[True], ~follows])[: len(first)])
    return at, np.diff(at, append=len(first))


def merged(spans: np.ndarray) -> np.ndarray:
    """Spans, packed as first << 32 | end, as rows of (first, end) that neither touch nor overlap."""
    spans = np.unique(spans)
    first, end = spans >> 32, np.maximum.accumulate(spans & 0xFFFFFFFF)
    new = np.concatenate([[True], first[1:] > end[:-1]])
    return np.stack([first[new], np.concatenate([end[:-1][new[1:]], end[-1:]])], axis=1)


def _list(lengths: list[int], columns: dict[str, list[np.ndarray]]) -> pa.Array:
    """A list of structs per row, from columns that lie one row after another."""
    flat = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in columns.values()]
    ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
    return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(flat, list(columns)))


def repeated_spans(docs: DataFrame, shelf: Shelf, text: str = "text") -> DataFrame:
    """(key, key2, spans) of each text with repeats: its fingerprints, and 64-bit pairs of first and end position."""

    @F.arrow_udf("array<struct<first:long,count:long,grp:long,content:long,times:long>>")
    def found(texts: pa.Array) -> pa.Array:
        lengths, columns = [], {"first": [], "count": [], "grp": [], "content": [], "times": []}
        for t in texts:
            n = 0
            for first, count, group, content, low, _ in stretches(t.as_py().encode(errors="replace")):
                at, times = runs(first, count, group, content)
                n += len(at)
                kept = (first[at] + low, count[at], group[at].view(np.int64), content[at].view(np.int64), times)
                for name, x in zip(columns, kept, strict=True):
                    columns[name].append(x)
            lengths.append(n)
        return _list(lengths, columns)

    @F.arrow_udf("array<struct<first:long,grp:long,name:long,single:long>>")
    def started(texts: pa.Array, wanted: pa.Array) -> pa.Array:
        lengths, columns = [], {"first": [], "grp": [], "name": [], "single": []}
        for t, w in zip(texts, wanted, strict=True):
            asked = np.array(w.as_py(), np.int64)
            asked.sort()
            n = 0
            for first, count, group, _, low, whole in stretches(t.as_py().encode(errors="replace")):
                at = np.searchsorted(asked >> 1, first + low)
                here = np.flatnonzero((at < len(asked)) & ((asked >> 1)[np.minimum(at, len(asked) - 1)] == first + low))
                starts = np.concatenate([np.arange(first[k], first[k] + count[k]) for k in here] or [np.zeros(0, np.int64)])
                columns["first"].append(starts + low)
                columns["grp"].append(np.repeat(group[here].view(np.int64), count[here]))
                columns["name"].append(whole(starts).view(np.int64))
                columns["single"].append(np.repeat(asked[at[here]] & 1, count[here]))
                n += len(starts)
            lengths.append(n)
        return _list(lengths, columns)

    @F.arrow_udf("binary")
    def joined(spans: pa.Array) -> pa.Array:
        return pa.array([merged(np.array(s.as_py(), np.int64)).tobytes() for s in spans], pa.binary())

    texts = keyed(docs, text).filter(F.col("n") >= LENGTH)
    rows = texts.select("key", "key2", F.inline(found("_t")))
    again = rows.groupBy("grp").agg(F.sum("times").alias("k")).filter("k > 1").select("grp")
    rows = shelf.store(rows.join(again, "grp", "left_semi"))
    kinds = rows.groupBy("grp", "content").agg(F.sum("times").alias("k"), F.min(F.struct("key", "key2", "first")).alias("one"))
    kinds = shelf.store(kinds)
    settled = rows.join(kinds.filter("k > 1").select("grp", "content"), ["grp", "content"], "left_semi")
    settled = settled.select("key", "key2", F.col("first"), (F.col("first") + F.col("count") * F.col("times") - 1 + LENGTH).alias("end"))
    # Stretches to look into: those that occur once in groups of several kinds, and one of each other kind there.
    open_ = kinds.groupBy("grp").agg(F.count("*").alias("kinds"), F.min("k").alias("least")).filter("kinds > 1 and least = 1")
    asked = kinds.join(open_.select("grp"), "grp", "left_semi").select("one.*", (F.col("k") == 1).cast("long").alias("single"))
    asked = asked.groupBy("key", "key2").agg(F.collect_list(F.col("first") * 2 + F.col("single")).alias("asked"))
    asked = shelf.store(asked)
    starts = sized_join(texts, asked, ["key", "key2"], "inner").select("key", "key2", F.inline(started("_t", "asked")))
    twice = starts.groupBy("grp", "name").agg(F.count("*").alias("k"), F.max("single").alias("s"))
    twice = twice.filter("k > 1 and s = 1").select("grp", "name")
    hits = starts.filter("single = 1").join(twice, ["grp", "name"], "left_semi")
    hits = hits.select("key", "key2", "first", (F.col("first") + LENGTH).alias("end"))
    spans = settled.union(hits).distinct()
    packed = spans.groupBy("key", "key2").agg(F.collect_list(F.shiftleft("first", 32).bitwiseOR(F.col("end"))).alias("spans"))
    return shelf.store(packed.select("key", "key2", joined("spans").alias("spans")))


def keyed(docs: DataFrame, text: str) -> DataFrame:
    """`docs` with the text as _t, its bytes as n, and fingerprints as key, and with the bytes as key2; equal texts are one."""
    found = docs.withColumn("_t", whole_text(text))
    n = F.octet_length("_t").cast("long")
    more = F.hash("_t").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    return found.withColumns({"key": F.xxhash64("_t"), "key2": F.shiftleft(n, 32).bitwiseOR(more), "n": n})


def remove_repeats(docs: DataFrame, text: str = "text", with_kept: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row; `kept` has the remaining bytes if `with_kept`.

    A byte goes if it is covered by LENGTH bytes that also start anywhere else, in the same or another text. Null
    texts are empty; repeated rows are each other's repeats; texts under LENGTH bytes lose nothing; other columns are
    not read. A block of BLOCK bytes is named at a time; beside the text a worker holds a row per 56 bytes or per run of a
    period, and the spans to be cut.
    """
    shelf = Shelf(docs.sparkSession)
    docs = docs.select(F.col("doc_id"), F.col(text).alias("text"))
    spans = repeated_spans(docs, shelf)

    @F.arrow_udf("struct<removed:long,spans:long,sha:string,kept:binary>")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = {"removed": [], "spans": [], "sha": [], "kept": []}
        for t, s in zip(texts, spans, strict=True):
            data, digest, at, kept = memoryview(t.as_py().encode(errors="replace")), hashlib.sha256(), 0, []
            pairs = np.frombuffer(s.as_py() or b"", np.int64).reshape(-1, 2).tolist()
            for first, end in [*pairs, (len(data), len(data))]:
                digest.update(data[at:first])
                kept.append(data[at:first])
                at = end
            out["removed"].append(sum(end - first for first, end in pairs))
            out["spans"].append(len(pairs))
            out["sha"].append(digest.hexdigest())
            out["kept"].append(b"".join(kept) if with_kept else None)
        return pa.StructArray.from_arrays([pa.array(v, k) for v, k in zip(out.values(), (pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True)], list(out))

    rows = sized_join(keyed(docs, "text"), spans, ["key", "key2"], "left")
    rows = rows.select("doc_id", F.col("n").alias("n_bytes"), cut("_t", "spans").alias("c"))
    columns = [F.col("c.removed").alias("n_removed"), F.col("c.spans").alias("n_spans"), F.col("c.sha").alias("kept_sha256")]
    rows = rows.select("doc_id", "n_bytes", *columns, *([F.col("c.kept").alias("kept")] if with_kept else []))
    return rows if with_kept else shelf.result(rows)
