"""Packing by lexical retrieval.

Documents are tokenised once into a table of token ids in the shared folder. Document frequencies of terms, which are
token ids, are counted over all of it. The table is dealt into shards of about equal size by content: a tree of cuts
through the documents' sketches, which are random projections of their weighted terms, so that related documents tend
to meet whatever the number of shards is. Neighbours are not sought outside the shard. A shard has a BM25 inverted
index of its documents: the unused neighbours that it returns for a seed document fill the seed's window one
after another, and the one that does not fit is cut, its rest staying unused. Whole windows of a long document are
sequences of their own. What is left at the end of a shard goes to sequences whose lengths are powers of two, which
need no padding.
"""

from __future__ import annotations

import functools
import os
import string
import sys
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.base import TOKENIZERS, ready, whole_text
from millrace.llm.token_counts import byte_letters
from millrace.session import scratch_path

WINDOW = 4096
END_OF_TEXT = 2
# Tokens of a shard: a shard is packed in one task's memory.
SHARD_TOKENS = 2_000_000
K1, B = 1.2, 0.75
# Neighbours that are ranked at a time, and the part of a shard, 1 in COMMON, from which a term is common.
NEIGHBOURS, COMMON = 32, 4
# Words after which a worker's memory of ids is full: it is set aside then, and words that are met again come back from
# there until the next time. No id depends on it. A dictionary doubles its tables beyond 699,050 entries.
REMEMBERED = 690_000
# A run of these at the end of a word is one piece.
MARKS = string.punctuation
TERMS = 1 << 16
# A seed is looked up by all of its terms.
QUERY_TERMS = TERMS
# Numbers of a sketch; documents sampled for a shard, and in all at most, to place the cuts.
SKETCH, PER_SHARD, SAMPLED = 64, 64, 200_000
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)


class WordIds(dict):
    """Blank-separated part of a lower-cased text to its token ids, as bytes of 16-bit numbers.

    Tokens never cross white space, so a text is the sum of its parts, and a part that of its pieces. That is done for
    texts of printable Latin-1 characters and the usual white space, which every Unicode version treats alike; any
    other text goes to the tokenizer whole.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > TERMS:
            raise ValueError("token ids do not fit into 16 bits")
        if sys.byteorder != "little":
            raise ValueError("ids are stored in little-endian order")
        self.before: dict[str, bytes] = {}
        self.tokenize, self.letters = self.tokenizer.model.tokenize, byte_letters()
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = regex.compile("|".join(regex.escape(t.content) for t in added.values()))
        self.settled = bytes(c for c in range(256) if unicodedata.category(chr(c)) != "Cc" or chr(c) in "\t\n\r\f\v")
        self.pieces = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall

    def __missing__(self, part: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.before = dict(self)
            self.clear()
        if (ids := self.before.get(part)) is not None:
            pass
        elif part.isalpha():
            letters = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
            ids = array("H", [t.id for t in self.tokenize(letters)]).tobytes()
        elif (letters := part.rstrip(MARKS)).isalpha():
            ids = self[letters] + self[part[len(letters) :]]
        elif len(pieces := self.pieces(part)) > 1:
            ids = b"".join(map(self.__getitem__, pieces))
        else:
            letters = "".join(pieces).encode().decode("latin-1").translate(self.letters)
            ids = array("H", [t.id for t in self.tokenize(letters)]).tobytes() if letters else b""
        self[part] = ids
        return ids

    def usual(self, text: str) -> bool:
        try:
            return not text.encode("latin-1").translate(None, self.settled) and not ("<|" in text and self.added.search(text))
        except UnicodeEncodeError:
            return False

    def encode(self, text: str) -> bytes:
        """Ids of a whole text and the end-of-text id."""
        if self.usual(text):
            ids = b"".join(map(self.__getitem__, text.lower().split()))
        else:
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()
        return ids + END_OF_TEXT.to_bytes(2, "little")


@functools.cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def tokenise(docs: DataFrame, text: str = "text", vocabulary: str = "word_bpe_49k.json", folder: str = TOKENIZERS) -> DataFrame:
    """`doc_id`, `ids` (16-bit little-endian) and `n` of each row, written to the shared folder and read back."""
    spark = ready(docs.sparkSession)
    path = os.path.join(folder, vocabulary)

    @F.arrow_udf("binary")
    def ids(texts: pa.Array) -> pa.Array:
        encode = word_ids(path).encode
        return pa.array([encode(t.as_py()) for t in texts], pa.binary())

    table = scratch_path(spark, "tokens")
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), ids(whole_text(text)).alias("ids"))
    found.withColumn("n", (F.length("ids") / 2).cast("long")).write.option("compression", "zstd").parquet(table)
    return spark.read.parquet(table)


def document_frequencies(tokens: DataFrame) -> np.ndarray:
    """In how many documents each token id occurs; one row per id and task is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(TERMS, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                total[np.frombuffer(ids.as_py(), "<u2")] += 1  # once, however often an id is repeated
        terms = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int32()), pa.array(total[terms])], ["term", "n"])

    rows = tokens.select("ids").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(TERMS, np.int64)
    for r in rows:  # one per vocabulary entry at most
        total[r.term] = r.n
    return total


def counted(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of each document in order, how often each occurs there, and how many they are per document.

    Terms and counts lie one document after another; no document is empty.
    """
    ends = np.cumsum([len(x) for x in ids])
    terms = np.concatenate([np.sort(x, kind="stable") for x in ids])  # by radix for 16-bit numbers
    last = np.empty(len(terms), bool)
    last[:-1] = terms[1:] != terms[:-1]
    last[ends - 1] = True
    at = np.flatnonzero(last)
    return terms[at], np.diff(at, prepend=-1), np.diff(np.searchsorted(at, ends), prepend=0)


@functools.cache
def signs() -> np.ndarray:
    """A random sign per term and place of a sketch."""
    return np.random.default_rng(1).integers(0, 2, (TERMS, SKETCH)).astype(np.int8) * np.int8(2) - np.int8(1)


def sketches_of(ids: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    """A row per document: its weighted terms projected onto random signs.

    Weights are whole numbers, small enough for sums of them to be exact, so that every machine finds the same.
    """
    if len(ids) > 1 and sum(map(len, ids)) > SHARD_TOKENS:  # long texts: their terms are counted in parts
        half = len(ids) // 2
        return np.concatenate([sketches_of(ids[:half], idf), sketches_of(ids[half:], idf)])
    found = np.empty((len(ids), SKETCH), np.float32)
    if len(ids):
        terms, tf, sizes = counted(ids)
        weights = np.rint(idf[terms] * (tf * (K1 + 1) / (tf + K1)).astype(np.float32) * 8)
        ends = np.cumsum(sizes).tolist()
        for row, a, b in zip(found, [0, *ends[:-1]], ends, strict=True):
            np.matmul(weights[a:b], signs().take(terms[a:b], axis=0).astype(np.float32), out=row)
    return found.astype(np.int32)


class Cuts:
    """Binary tree that deals documents to shards by their sketches; equal sketches are told apart by a salt.

    Each node halves its part of the sample, by tokens, across the direction in which the sketches differ most. A large
    group of copies is cut by the salt like any other part, so no shard grows with it.
    """

    def __init__(self, sketches: np.ndarray, salts: np.ndarray, sizes: np.ndarray, shards: int) -> None:
        self.normals, self.cuts, self.salts, self.below = [], [], [], []
        self.leaves = 0
        self._grow(sketches, salts, sizes, np.arange(len(sketches)), shards)
        self.normals = np.array(self.normals, np.int64).reshape(-1, SKETCH)
        self.cuts, self.salts = np.array(self.cuts, np.float64), np.array(self.salts, np.int64)
        self.below = np.array(self.below, np.int64).reshape(-1, 2)

    def _grow(self, sketches: np.ndarray, salts: np.ndarray, sizes: np.ndarray, part: np.ndarray, shards: int) -> int:
        """The node that cuts `part` into so many shards; leaves are numbered from -1 down."""
        if shards == 1:
            self.leaves += 1
            return -self.leaves
        node, left = len(self.cuts), shards // 2
        normal = np.zeros(SKETCH, np.int64)
        if len(part) > 1:
            x = sketches[part] / self.norms(sketches[part])[:, None]
            spread = np.linalg.eigh(np.cov(x, rowvar=False))[1][:, -1]
            normal = np.rint(spread * (1 << 15)).astype(np.int64)
        values = self.values(sketches[part], normal[None])
        order = np.lexsort((salts[part], values))
        filled = np.cumsum(sizes[part][order])
        at = int(np.searchsorted(filled, filled[-1] * left / shards)) if len(part) > 1 else 0
        # A part that the sample says nothing of is cut by the salt alone.
        everywhere = int((left / shards - 0.5) * 2.0**64)
        self.normals.append(normal)
        self.cuts.append(values[order[at]] if len(part) > 1 else 0.0)
        self.salts.append(salts[part][order[at]] if len(part) > 1 else everywhere)
        self.below.append((0, 0))
        low = self._grow(sketches, salts, sizes, part[order[: at + 1]] if len(part) > 1 else part, left)
        high = self._grow(sketches, salts, sizes, part[order[at + 1 :]] if len(part) > 1 else part, shards - left)
        self.below[node] = (low, high)
        return node

    @staticmethod
    def norms(sketches: np.ndarray) -> np.ndarray:
        return np.maximum(np.sqrt((sketches.astype(np.int64) ** 2).sum(axis=1).astype(np.float64)), 1.0)

    def values(self, sketches: np.ndarray, normals: np.ndarray) -> np.ndarray:
        return (sketches.astype(np.int64) * normals).sum(axis=1) / self.norms(sketches)

    def shards(self, sketches: np.ndarray, salts: np.ndarray) -> np.ndarray:
        """Shard of each document."""
        node = np.full(len(sketches), 0 if len(self.cuts) else -1, np.int64)
        while len(at := np.flatnonzero(node >= 0)):
            here = node[at]
            values = self.values(sketches[at], self.normals[here])
            high = (values > self.cuts[here]) | ((values == self.cuts[here]) & (salts[at] > self.salts[here]))
            node[at] = self.below[here, high.astype(np.int64)]
        return -1 - node


def dealt(tokens: DataFrame, idf: np.ndarray, n_docs: int, shards: int) -> DataFrame:
    """doc_id, ids and shard of each row of `tokens`."""
    # The row number keeps rows that repeat an id from meeting in one shard.
    salted = tokens.select("doc_id", "ids", "n", F.xxhash64("doc_id", "_metadata.row_index").alias("salt"))
    if shards == 1:
        return salted.select("doc_id", "ids", F.lit(0).cast("long").alias("shard"))

    @F.arrow_udf("binary")
    def sketches(ids: pa.Array) -> pa.Array:
        rows = sketches_of([np.frombuffer(x.as_py(), "<u2") for x in ids], idf)
        return pa.array([x.tobytes() for x in rows.astype("<i4")], pa.binary())

    part = min(shards * PER_SHARD, SAMPLED) / n_docs
    chosen = salted.filter(F.pmod(F.xxhash64("salt"), F.lit(1 << 30)) < F.lit(int(min(part, 1.0) * (1 << 30))))
    sample = chosen.select(sketches("ids").alias("s"), "salt", "n").toArrow().sort_by("salt")
    found = np.frombuffer(b"".join(sample.column("s").to_pylist()), "<i4").reshape(-1, SKETCH)
    cuts = Cuts(found, sample.column("salt").to_numpy(), sample.column("n").to_numpy(), shards)

    @F.arrow_udf("long")
    def place(ids: pa.Array, salt: pa.Array) -> pa.Array:
        rows = sketches_of([np.frombuffer(x.as_py(), "<u2") for x in ids], idf)
        return pa.array(cuts.shards(rows, salt.to_numpy(zero_copy_only=False)), pa.int64())

    return salted.select("doc_id", "ids", place("ids", "salt").alias("shard"))


class Index:
    """BM25 inverted index of a shard's documents: per term the documents that have it, with their weights.

    Common terms have a row with the weights of all documents instead; there are at most COMMON times as many numbers
    in such rows as the terms occur in documents.
    """

    def __init__(self, ids: list[np.ndarray], idf: np.ndarray) -> None:
        self.n = len(ids)
        term, tf, sizes = counted(ids)
        tf = tf.astype(np.float32)
        self.terms = np.split(term, np.cumsum(sizes)[:-1])
        lengths = np.array([len(x) for x in ids], np.float32)
        norm = np.repeat(K1 * (1 - B + B * lengths / lengths.mean()), sizes).astype(np.float32)
        order = np.argsort(term, kind="stable")
        self.docs = np.repeat(np.arange(self.n), sizes)[order]
        self.weights = (idf[term] * tf * np.float32(K1 + 1) / (tf + norm)).astype(np.float32)[order]
        self.starts = np.searchsorted(term[order], np.arange(len(idf) + 1))
        common = np.flatnonzero(np.diff(self.starts) * COMMON >= self.n)
        self.row = np.full(len(idf), -1, np.int32)
        self.row[common] = np.arange(len(common))
        self.rows = np.zeros((len(common), self.n), np.float32)
        for row, t in zip(self.rows, common, strict=True):
            part = slice(self.starts[t], self.starts[t + 1])
            row[self.docs[part]] = self.weights[part]

    def neighbours(self, seed: int, unused: np.ndarray) -> Iterator[int]:
        """Unused documents by falling score for all of the seed's terms, then in order."""
        terms = self.terms[seed]
        rows = self.row[terms]
        asked = np.zeros(len(self.rows), np.float32)
        asked[rows[rows >= 0]] = 1
        scores = asked @ self.rows
        rare = terms[rows < 0]
        sizes = self.starts[rare + 1] - self.starts[rare]
        ends = np.cumsum(sizes)
        postings = np.arange(ends[-1] if len(rare) else 0) + np.repeat(self.starts[rare] - ends + sizes, sizes)
        # All are within bounds; to clip is faster than to check them.
        np.add.at(scores, self.docs.take(postings, mode="clip"), self.weights.take(postings, mode="clip"))
        scores[~unused] = 0
        while True:
            top = np.argpartition(-scores, NEIGHBOURS)[:NEIGHBOURS] if self.n > NEIGHBOURS else np.arange(self.n)
            top = top[scores[top] > 0]
            if not len(top):
                break
            yield from top[np.lexsort((top, -scores[top]))].tolist()
            scores[top] = 0


def pack_shard(ids: list[np.ndarray], idf: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece; every token is in exactly one.

    A sequence has WINDOW tokens, or a power of two. Seeds are taken in the order given.
    """
    sequence, start = 0, [0] * len(ids)
    for at, x in enumerate(ids):
        while len(x) - start[at] >= WINDOW:
            yield at, start[at], WINDOW, sequence, 0
            sequence, start[at] = sequence + 1, start[at] + WINDOW
    rest = np.array([len(x) for x in ids]) - start
    unused = rest > 0
    index = Index(ids, idf) if len(ids) else None
    following = 0
    while True:
        while following < len(ids) and not unused[following]:
            following += 1
        if following == len(ids):
            return
        seed, taken, filled = following, [], 0

        def candidates(seed=seed):
            yield seed
            yield from index.neighbours(seed, unused)
            for other in range(seed, len(ids)):
                if unused[other]:
                    yield other

        for doc in candidates():
            if not unused[doc]:
                continue
            length = int(min(rest[doc], WINDOW - filled))
            taken.append((doc, start[doc], length))
            start[doc], rest[doc], filled = start[doc] + length, rest[doc] - length, filled + length
            unused[doc] = rest[doc] > 0
            if filled == WINDOW:
                break
        for size in [WINDOW] if filled == WINDOW else [1 << k for k in range(12, -1, -1) if filled >> k & 1]:
            offset = 0
            while offset < size:
                doc, begin, length = taken.pop(0)
                part = min(length, size - offset)
                yield doc, begin, part, sequence, offset
                offset += part
                if part < length:
                    taken.insert(0, (doc, begin + part, length - part))
            sequence += 1


def pack(docs: DataFrame, text: str = "text", shard_tokens: int = SHARD_TOKENS, with_ids: bool = False) -> DataFrame:
    """Pieces of the sequences that the whole texts of `docs` are packed into.

    doc_id, start, length and ids_crc32 of the piece, doc_tokens of its document, sequence_id and offset of its
    place; `ids` has its tokens as 32-bit numbers if `with_ids`. Null text counts as empty and is one token; rows
    that repeat a doc_id are documents of their own; null ids stay null; other columns are not read.
    """
    tokens = tokenise(docs, text)
    n_docs, n_tokens = tokens.agg(F.count("*"), F.sum("n")).first()
    frequencies = document_frequencies(tokens)
    idf = np.log1p((n_docs - frequencies + 0.5) / (frequencies + 0.5)).astype(np.float32)
    shards = max(1, -(-(n_tokens or 0) // shard_tokens))
    fields = [pa.field(n, pa.int64()) for n in PIECES.replace(" long", "").replace(" binary", "").split(", ")[:-1]]
    schema = pa.schema([*fields, pa.field("ids", pa.binary())])

    def pieces(key: tuple[pa.Scalar], group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by("doc_id")
        ids = [np.frombuffer(x.as_py(), "<u2") for x in group.column("ids")]
        names, rows = group.column("doc_id").to_pylist(), []
        for doc, start, length, sequence, offset in pack_shard(ids, idf):
            part = ids[doc][start : start + length].astype("<u4").tobytes()
            place = (key[0].as_py() << 32) + sequence
            rows.append((names[doc], start, length, zlib.crc32(part), len(ids[doc]), place, offset, part if with_ids else None))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    found = dealt(tokens, idf, n_docs, shards).groupBy("shard").applyInArrow(pieces, PIECES)
    return found if with_ids else found.drop("ids")
