"""What the operators share: sessions, the tokenizer files, and small column expressions."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.roles import table
from millrace.session import delete_path, scratch_path, shared_dir

# Rows that go to a Python worker at once. Texts may be long, and a worker has a few hundred MB.
BATCH_ROWS = 256
# The white space of the contracts, as a character class without its brackets.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"

TOKENIZERS = os.path.dirname(public_tokenizers.__file__)


def ready(spark: SparkSession, rows: int = BATCH_ROWS) -> SparkSession:
    """A session that hands Python workers small batches and can checkpoint into the shared folder."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return spark


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, whole."""
    return table(ready(spark), sf_dir, name)


def whole_text(column: str = "text") -> Column:
    """The text, empty if null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def crc32_of(column: str) -> Column:
    """CRC-32 of a column's text form."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def placed(seed: int, *columns: str) -> Column:
    """A 60-bit number from the columns' text forms, in a form that other engines can compute too."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores after it until it is none of the frame's columns (nor of the names before)."""
    taken, free = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        free.append(name)
    return free


def located(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """`docs` with the file and row that each of its rows lies at, and the names of these two columns.

    A frame that is not a file scan is stored first. The place tells rows apart that have nothing else to do so.
    """
    names = free_names(docs, "__path", "__row")
    place = [F.col(f"_metadata.{field}").alias(name) for field, name in zip(("file_path", "row_index"), names, strict=True)]
    try:
        return docs.select("*", *place), names
    except AnalysisException:
        spark = docs.sparkSession
        path = scratch_path(spark, "documents")
        docs.write.parquet(path)
        return spark.read.parquet(path).select("*", *place), names


def crc32_sql(text: str) -> str:
    """CRC-32 of a text's bytes as DuckDB SQL, over a view `crc_steps` with one row, see `CRC_STEPS`."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    step = "lambda a, b: xor(a >> 8, steps[1 + (xor(a, b) & 255)])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), {step}), 4294967295)"


# What each value of a byte adds to a CRC-32, as common table expressions.
CRC_STEPS = """
crc_bits(i, k, c) AS (
    SELECT i, 0, i FROM range(256) r(i)
    UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_bits WHERE k < 8),
crc_steps AS (SELECT list(c ORDER BY i) AS steps FROM crc_bits WHERE k = 8)"""


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings that hold while something runs to its end, and are as before afterwards."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


class Shelf:
    """Frames computed once into the shared folder as Parquet, to be deleted together.

    Unlike those of a checkpoint, plans over a stored frame start from its true size, which matters in loops.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = ready(spark), []

    def store(self, df: DataFrame) -> DataFrame:
        self.paths.append(scratch_path(self.spark, "stored"))
        df.write.parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])

    def result(self, df: DataFrame) -> DataFrame:
        """`df` computed and kept, everything stored deleted."""
        found = df.checkpoint()
        for path in self.paths:
            delete_path(self.spark, path)
        self.paths = []
        return found
