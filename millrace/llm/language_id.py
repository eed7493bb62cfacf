"""Language identification with a string kernel.

A text is the set of its byte n-grams of 1 to 3 bytes, folded into a fixed number of cells (blended-spectrum presence).
The kernel of two texts is the size of the intersection over the geometric mean of the sizes. Kernel ridge
regression, one against the rest, is solved on Nyström landmarks; a batch of texts is scored by two matrix products,
texts by landmarks and landmarks by languages.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import crc32_of, free_names, placed, ready, whole_text
from millrace.operators import rank_limit
from millrace.plans.sizing import sized_join

CELLS = 1 << 13
ORDERS = (1, 2, 3)
# Labelled documents per language that the model is fitted on, and how many of them all are landmarks.
PER_LANGUAGE = 400
LANDMARKS = 128
SALTS = 64
RIDGE = 1e-4
SHARPNESS = 6.0
# Bytes of a text that are cut into n-grams at a time.
BLOCK = 1 << 20
UNDETERMINED = "und"


def presence(text: str) -> np.ndarray:
    """Which cells the n-grams of the whole text fall into."""
    cells = np.zeros(CELLS, np.uint8)
    data = np.frombuffer(text.lower().encode(errors="replace"), np.uint8)
    for start in range(0, len(data), BLOCK):
        block = data[start : start + BLOCK + max(ORDERS) - 1].astype(np.uint32)
        for n in ORDERS:
            gram = block[: len(block) - n + 1].copy()
            for at in range(1, n):
                gram = gram * np.uint32(257) + block[at : len(block) - n + 1 + at]
            cells[((gram + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(32 - CELLS.bit_length() + 1)] = 1
    return cells


def kernel(texts: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Normalised presence kernel of rows of 0 and 1; a row without n-grams is similar to nothing."""
    sizes = [np.sqrt(np.maximum(x.sum(axis=1, dtype=np.float32), 1)) for x in (texts, landmarks)]
    product = texts.astype(np.float32) @ landmarks.astype(np.float32).T
    return product / sizes[0][:, None] / sizes[1]


@dataclass
class Model:
    """Languages, packed presence rows of the landmarks, and a weight per landmark and language."""

    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        if not texts or not self.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        rows = np.stack([presence(t) for t in texts])
        raw = kernel(rows, np.unpackbits(self.landmarks, axis=1)) @ self.weights
        odds = np.exp(SHARPNESS * (raw - raw.max(axis=1, keepdims=True)))
        best = raw.argmax(axis=1)
        return [self.languages[i] for i in best], (odds.max(axis=1) / odds.sum(axis=1)).astype(float).tolist()


def fit(labels: list[str], packed: np.ndarray, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Kernel ridge regression with landmarks dealt out evenly over the languages."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], packed, np.zeros((0, 0)))
    rows = np.unpackbits(packed, axis=1)
    each = max(1, landmarks // len(languages))
    chosen = [i for name in languages for i in [i for i, x in enumerate(labels) if x == name][:each]]
    marks = rows[chosen]
    k_nm, k_mm = kernel(rows, marks).astype(np.float64), kernel(marks, marks).astype(np.float64)
    target = np.where(np.array(labels)[:, None] == np.array(languages), 1.0, -1.0)
    # Each language weighs the same, however many examples it has.
    weight = 1.0 / np.array([labels.count(x) for x in labels])[:, None]
    left = k_nm.T @ (weight * k_nm) + ridge * k_mm + 1e-9 * np.eye(len(chosen))
    return Model(languages, packed[chosen], np.linalg.solve(left, k_nm.T @ (weight * target)).astype(np.float32))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """Fit on at most `per_language` documents of each language, chosen by a hash of doc_id.

    Documents without a language or without a letter teach nothing and take no place, nor do repeated ids. The driver gets the presence bits (1 KB each)
    of the chosen documents only.
    """
    ready(docs.sparkSession)
    known = docs.select("doc_id", F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    known = known.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("_at", placed(10, "doc_id"))
    # First within salted parts of a language, so that the task that merges one gets SALTS * per_language rows at most.
    first = known.select("lang", "_at", (F.col("_at") % SALTS).alias("_salt")).distinct()
    first = rank_limit(rank_limit(first, ["lang", "_salt"], [F.col("_at")], per_language), ["lang"], [F.col("_at")], per_language)
    cuts = first.groupBy("lang").agg(F.max("_at").alias("_cut"))
    chosen = sized_join(known, cuts, ["lang"], "inner").filter(F.col("_at") <= F.col("_cut"))
    chosen = chosen.dropDuplicates(["lang", "doc_id"])

    @F.arrow_udf("binary")
    def bits(texts: pa.Array) -> pa.Array:
        return pa.array([np.packbits(presence(t.as_py())).tobytes() for t in texts], pa.binary())

    rows = chosen.select("lang", "_at", bits("text").alias("bits")).orderBy("lang", "_at", "bits").collect()
    packed = [np.frombuffer(r.bits, np.uint8) for r in rows]
    return fit([r.lang for r in rows], np.stack(packed) if packed else np.zeros((0, CELLS // 8), np.uint8))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with `lang_pred` and `score`, from the whole text alone.

    `und` with score 0 if the text is null or has no letter, or if the model has learned nothing; columns of the new
    names are replaced, others stay, and repeated rows get the same answer.
    """
    ready(docs.sparkSession)

    @F.arrow_udf("struct<lang:string,score:double>")
    def scored(texts: pa.Array) -> pa.Array:
        names, scores = model.predict(texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    (name,) = free_names(docs, "_l")
    found = docs.withColumn(name, scored(whole_text(text)))
    letters = F.coalesce(F.col(text).cast("string").rlike(r"\p{L}"), F.lit(False))
    return found.withColumns(
        {
            "lang_pred": F.when(letters, F.col(f"{name}.lang")).otherwise(UNDETERMINED),
            "score": F.when(letters, F.col(f"{name}.score")).otherwise(0.0),
        }
    ).drop(name)


def held_out(docs: DataFrame) -> DataFrame:
    """`docs` with `held_out`: whether CRC-32 of doc_id leaves 2 after division by 4."""
    return docs.withColumn("held_out", F.coalesce(crc32_of("doc_id") % 4 == 2, F.lit(False)))
