"""Quality classifier: a generalised additive model with pairwise interactions.

Boosting goes round the features in turn; each step fits a tree with a few leaves on one binned feature and adds it to
that feature's lookup table, then the same for the pairs that promise most. What is left is a table per feature and
per pair, so a text is scored by looking up its bins and adding.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import crc32_of, placed, ready, whole_text

# Labelled documents that the model is fitted on, at most.
SAMPLE = 20_000
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 120, 60, 8
RATE, LEAVES, SHRINK = 0.15, 3, 4.0
THRESHOLD = 0.3

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
# Classes of bytes whose shares are features.
CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>", b".,;:", b"!?", b"\n", b" \t\r\v\f", bytes(range(128, 256)))
FEATURES = (
    "bytes", "words", "word_length", "capitals", "digits", "symbols", "stops", "exclaims", "breaks", "blanks", "high",
    "distinct_words", "distinct_lines", "line_words", "longest_word",
)
MASK = np.array([[b in group for b in range(256)] for group in CLASSES], np.int64)


def features(text: str) -> list[float]:
    """FEATURES of a whole text; an empty one has zeros only."""
    data = np.frombuffer(text.encode(errors="replace"), np.uint8)
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if x]
    n_bytes, n_words = max(1, len(data)), max(1, len(words))
    shares = (MASK @ np.bincount(data, minlength=256)) / n_bytes
    sizes = [len(data), len(words), len(words) / max(1, len(lines)), max(map(len, words), default=0)]
    bytes_, words_, line_words, longest = np.log1p(sizes).tolist()
    return [
        bytes_, words_, len(data) / n_words, *shares.tolist(), len(set(words)) / n_words,
        len(set(lines)) / max(1, len(lines)), line_words, longest,
    ]


def leaves(gain: np.ndarray, weight: np.ndarray, most: int = LEAVES) -> np.ndarray:
    """A tree over ordered bins: the best cuts one after another, and per bin the step of its leaf."""
    cuts = [0, len(gain)]
    g, h = (np.concatenate([[0.0], np.cumsum(x)]) for x in (gain, weight))

    def worth(a, b):
        return (g[b] - g[a]) ** 2 / (h[b] - h[a] + SHRINK)

    for _ in range(most - 1):
        best, where = 1e-12, None
        for a, b in zip(cuts, cuts[1:], strict=False):
            at = np.arange(a + 1, b)
            if len(at):
                better = worth(a, at) + worth(at, b) - worth(a, b)
                if better.max() > best:
                    best, where = better.max(), int(at[better.argmax()])
        if where is None:
            break
        cuts = sorted([*cuts, where])
    step = np.zeros(len(gain))
    for a, b in zip(cuts, cuts[1:], strict=False):
        step[a:b] = (g[b] - g[a]) / (h[b] - h[a] + SHRINK)
    return step


def pair_leaves(gain: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A tree of depth two over two binned features: one cut of the first, then one of the second on each side."""
    best, step = -1.0, np.zeros_like(gain)
    for cut in range(1, len(gain)):
        sides = [leaves(x[0], x[1], 2) for x in ((gain[s].sum(0), weight[s].sum(0)) for s in (slice(cut), slice(cut, None)))]
        worth = sum(float((s * gain[part].sum(0)).sum()) for s, part in zip(sides, (slice(cut), slice(cut, None)), strict=True))
        if worth > best:
            best = worth
            step = np.concatenate([np.tile(sides[0], (cut, 1)), np.tile(sides[1], (len(gain) - cut, 1))])
    return step


@dataclass
class Gam:
    """Bin edges and tables; `score` only looks up and adds."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, rows[:, j], "right")]
        for (a, b), table in self.pairs.items():
            total += table[tuple(np.searchsorted(self.pair_edges[j], rows[:, j], "right") for j in (a, b))]
        return 1 / (1 + np.exp(-total))


def edges_of(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def fit(rows: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS, pair_rounds: int = PAIR_ROUNDS) -> Gam:
    """Cyclic boosting of logistic loss. Without rows every score is a half."""
    if not len(rows):
        return Gam()
    rate = (labels.sum() + 0.5) / (len(labels) + 1)
    model = Gam(base=float(np.log(rate / (1 - rate))))
    model.edges = [edges_of(x, BINS) for x in rows.T]
    model.pair_edges = [edges_of(x, PAIR_BINS) for x in rows.T]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    places = [np.searchsorted(e, x, "right") for e, x in zip(model.edges, rows.T, strict=True)]
    coarse = [np.searchsorted(e, x, "right") for e, x in zip(model.pair_edges, rows.T, strict=True)]
    total = np.full(len(rows), model.base)

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    def sums(at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.bincount(at, x, size) for x in slope())

    for _ in range(rounds):
        for j, at in enumerate(places):
            step = RATE * leaves(*sums(at, len(model.tables[j])))
            model.tables[j] += step
            total += step[at]

    def flat(a: int, b: int) -> tuple[np.ndarray, tuple[int, int]]:
        shape = (len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1)
        return coarse[a] * shape[1] + coarse[b], shape

    promise = {}
    for a in range(rows.shape[1]):
        for b in range(a + 1, rows.shape[1]):
            at, shape = flat(a, b)
            gain, weight = (x.reshape(shape) for x in sums(at, shape[0] * shape[1]))
            promise[a, b] = float((pair_leaves(gain, weight) * gain).sum())
    for a, b in sorted(sorted(promise, key=promise.get)[-PAIRS:]):
        model.pairs[a, b] = np.zeros(flat(a, b)[1])
    for _ in range(pair_rounds):
        for (a, b), table in model.pairs.items():
            at, shape = flat(a, b)
            step = RATE * pair_leaves(*(x.reshape(shape) for x in sums(at, shape[0] * shape[1])))
            table += step
            total += step.ravel()[at]
    return model


def in_training(column: str = "doc_id"):
    """Whether a document's label may be learned: CRC-32 of its id is no multiple of 5; a null id is not learned from."""
    return F.coalesce(crc32_of(column) % 5 != 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", most: int = SAMPLE) -> Gam:
    """Fit on at most `most` labelled documents outside the held-out fold, chosen by a hash of doc_id.

    Null labels are left out; a document labelled twice counts twice. The driver gets the features of the chosen
    rows only.
    """
    ready(docs.sparkSession)
    usable = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("_y")).filter(F.col("_y").isNotNull() & in_training())
    usable = usable.withColumn("_at", placed(6, "doc_id"))
    # A hash cut leaves little more than is wanted, so that the tasks do not each send `most` rows.
    cut = int(min(1.0, 1.2 * most / max(1, usable.count())) * (1 << 60))
    chosen = usable.filter(F.col("_at") <= cut).orderBy("_at", "doc_id", "_y").limit(most).select("doc_id", "_y")

    @F.arrow_udf("array<double>")
    def numbers(texts: pa.Array) -> pa.Array:
        return pa.array([features(t.as_py()) for t in texts], pa.list_(pa.float64()))

    # At most `most` rows of 16 bytes.
    found = docs.select("doc_id", whole_text(text).alias("_t")).join(F.broadcast(chosen), "doc_id")
    rows = found.select("_y", numbers("_t").alias("x")).orderBy("_y", "x").collect()
    x = np.array([r.x for r in rows]) if rows else np.zeros((0, len(FEATURES)))
    return fit(x, np.array([r["_y"] for r in rows], float))


def classify(docs: DataFrame, model: Gam, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with `held_out`, `score` (chance of label 1) and `predicted` (1 from the threshold on).

    The whole text is all that a score depends on; null counts as empty and is scored like any text. Columns of the
    new names are replaced, others stay.
    """
    ready(docs.sparkSession)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(np.array([features(t.as_py()) for t in texts])) if len(texts) else [], pa.float64())

    held = F.coalesce(crc32_of("doc_id") % 5 == 0, F.lit(False))
    found = docs.withColumns({"held_out": held, "score": scored(whole_text(text))})
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
