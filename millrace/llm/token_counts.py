"""Token counts of a byte-level BPE, with a shortcut for pre-tokens that are whole tokens.

Before any text is read, each vocabulary string is put through the merges on its own. Those that come out as one
token form the whole-token table; the proof covers the vocabulary, so the table is bounded by it. A text is cut
into pre-tokens. One that is in the table counts 1; only the others are merged.
"""

from __future__ import annotations

import functools
import os

import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.base import TOKENIZERS, ready, whole_text

# Merged pre-tokens a worker remembers; the memory is emptied when full, and no count depends on it.
REMEMBERED = 200_000
# Below this code point the pattern's classes are the same in every Unicode version (tests go through them all).
SETTLED = 0x250


def byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for U+0100 and on, in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + at) for at, b in enumerate(hidden)}


class Counter(dict):
    """Pre-token to its number of tokens: whole tokens are there from the start, the rest is merged when met."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added):
            raise ValueError("added tokens that take in their surroundings are not supported")
        self.added = regex.compile("|".join(regex.escape(t.content) for t in added)) if added else None
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.unsettled = regex.compile(f"[^\x00-{chr(SETTLED - 1)}]")
        self.whole = self.prove()
        super().__init__(self.whole)

    def prove(self) -> dict[str, int]:
        """Vocabulary strings that the merges bring to one token and that the pattern leaves in one piece."""
        back = {letter: b for b, letter in self.letters.items()}
        table = {}
        for token in self.tokenizer.get_vocab(with_added_tokens=False):
            try:
                piece = bytes(back[c] for c in token).decode()
            except (KeyError, UnicodeDecodeError):
                continue
            if len(self.model.tokenize(token)) == 1 and self.pattern.findall(piece) == [piece]:
                table[piece] = 1
        return table

    def merged(self, letters: str) -> int:
        return len(self.model.tokenize(letters))

    def __missing__(self, piece: str) -> int:
        if len(self) >= len(self.whole) + REMEMBERED:
            self.clear()
            self.update(self.whole)
        n = self.merged(piece.encode().decode("latin-1").translate(self.letters))
        self[piece] = n
        return n

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        parts = self.added.split(text) if self.added else [text]
        n = len(parts) - 1
        for part in parts:
            if self.unsettled.search(part):
                n += sum(self.merged(p) for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part))
            else:
                n += sum(map(self.__getitem__, self.pattern.findall(part)))
        return n


@functools.cache
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(
    docs: DataFrame, text: str = "text", vocabulary: str = "byte_bpe_50k.json", folder: str = TOKENIZERS, limit: int = 512
) -> DataFrame:
    """`docs` with `n_bytes`, `n_tokens` and `over_limit` (more than `limit` tokens) of the whole `text`.

    Null counts as empty: 0 bytes, 0 tokens. Repeated rows each get their count; columns of the new names are
    replaced, other columns stay. `folder` must hold the vocabulary file on every executor.
    """
    ready(docs.sparkSession)
    path = os.path.join(folder, vocabulary)

    @F.arrow_udf("long")
    def tokens(texts: pa.Array) -> pa.Array:
        count = counter(path).count
        return pa.array([count(t.as_py()) for t in texts], pa.int64())

    return docs.withColumns(
        {"n_bytes": F.octet_length(whole_text(text)).cast("long"), "n_tokens": tokens(whole_text(text))}
    ).withColumn("over_limit", F.col("n_tokens") > limit)
