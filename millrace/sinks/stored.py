"""Stored tables whose changes become visible all at once.

A store is a folder with data files, none of which is ever changed, and numbered versions, each a small JSON file that
names the data files of every table in the store. A change writes new data files first and then one new version, by a
rename that fails if the number is taken. So a reader sees the rows before or after a change; a writer that dies leaves
files that no version names; of two writers that start from one version the second fails and changes nothing; and
what a reader planned stays readable until its version expires.

Replacing writes all files, appending adds some, `upsert_rows` and `increment_stored` write only files that hold rows they
touch. Several tables of one store change together, which is how one stream writes several outputs.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.operators.mutation import apply_increments, increment_targets
from millrace.plans.sizing import same
from millrace.session import adaptive, delete_path, materialise, matching_paths, path_exists, read_text, rename_new, write_text

ROWS = "rows"
# Versions that stay readable however old they are, and for how many seconds any version does.
KEPT_VERSIONS = 3
KEPT_SECONDS = 3600
BUCKETS = 64
# Column that deals a keyed table's rows over its folders.
BUCKET = "_bucket"


class ConcurrentChange(RuntimeError):
    """Another writer has made the version that this one was about to make."""


class Version(NamedTuple):
    """What a store holds: per table its schema (JSON) and files as [place, bucket], and notes of its writers."""

    number: int
    tables: dict
    notes: dict

    def files(self, table: str = ROWS) -> list[list]:
        return self.tables[table]["files"] if table in self.tables else []


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(p.rsplit("/", 1)[1].removesuffix(".json")) for p in matching_paths(spark, f"{path}/versions/*.json")]


def stored_version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """The last version of a store, or the one of a given number. A store that nobody has written has version -1."""
    if number is None:
        number = max(_numbers(spark, path), default=-1)
    if number < 0:
        return Version(-1, {}, {})
    found = json.loads(read_text(spark, f"{path}/versions/{number:012d}.json"))
    return Version(number, found["tables"], found["notes"])


def commit(spark: SparkSession, path: str, before: Version, changed: dict, notes: dict | None = None) -> Version:
    """Make the next version: `changed` tables replace those of their names, `notes` are added. Raises ConcurrentChange."""
    after = Version(before.number + 1, {**before.tables, **changed}, {**before.notes, **(notes or {})})
    text = json.dumps({"tables": after.tables, "notes": after.notes, "at": time.time()})
    aside = f"{path}/versions/{uuid.uuid4().hex}.new"
    write_text(spark, aside, text)
    if not rename_new(spark, aside, f"{path}/versions/{after.number:012d}.json"):
        delete_path(spark, aside)
        raise ConcurrentChange(f"version {after.number} of {path} is taken")
    return after


def new_files(df: DataFrame, path: str) -> list[list]:
    """Write rows as files that no version names yet; returns [place, bucket] of each.

    A frame with a column `_bucket` is written by buckets, several files for one that is large.
    """
    folder = f"data/{uuid.uuid4().hex}"
    if BUCKET in df.columns:
        # Without AQE, as in the step of a stream, the hint does nothing and every task writes a file per bucket.
        with adaptive(df.sparkSession):
            df.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/{folder}")
        found = matching_paths(df.sparkSession, f"{path}/{folder}/{BUCKET}=*/part-*")
        return [[f"{folder}/" + "/".join(f.split("/")[-2:]), int(f.split("/")[-2].split("=")[1])] for f in found]
    df.write.parquet(f"{path}/{folder}")
    return [[f"{folder}/{f.rsplit('/', 1)[1]}", None] for f in matching_paths(df.sparkSession, f"{path}/{folder}/part-*")]


def table_of(df: DataFrame, files: list[list]) -> dict:
    schema = StructType([f for f in df.schema if f.name != BUCKET])
    return {"schema": schema.json(), "files": files}


def _scan(spark: SparkSession, path: str, version: Version, table: str, files: list[list] | None = None) -> DataFrame:
    files = version.files(table) if files is None else files
    schema = StructType.fromJson(json.loads(version.tables[table]["schema"]))
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{path}/{place}" for place, _ in files))


def read_stored(spark: SparkSession, path: str, table: str = ROWS, number: int | None = None) -> DataFrame:
    """A table of a store at its last version or a given one. The frame goes on reading that version's files."""
    version = stored_version(spark, path, number)
    if table not in version.tables:
        raise FileNotFoundError(f"no table {table} in {path}")
    return _scan(spark, path, version, table)


def _done(version: Version, batch: tuple[str, int] | None) -> bool:
    return batch is not None and version.notes.get(f"batch:{batch[0]}", -1) >= batch[1]


def _noted(batch: tuple[str, int] | None) -> dict:
    return {f"batch:{batch[0]}": batch[1]} if batch else {}


def replace_rows(df: DataFrame, path: str, table: str = ROWS, batch: tuple[str, int] | None = None) -> Version:
    """The table becomes `df`. It may read the table that it replaces."""
    spark = df.sparkSession
    before = stored_version(spark, path)
    if _done(before, batch):
        return before
    return commit(spark, path, before, {table: table_of(df, new_files(df, path))}, _noted(batch))


def append_rows(df: DataFrame, path: str, table: str = ROWS, batch: tuple[str, int] | None = None) -> Version:
    """Add rows. With `batch`, a writer's name and a number that grows, a batch that was added before adds nothing."""
    spark = df.sparkSession
    before = stored_version(spark, path)
    if _done(before, batch):
        return before
    files = [*before.files(table), *new_files(df, path)]
    return commit(spark, path, before, {table: table_of(df, files)}, _noted(batch))


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def replace_by_key(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows in place of the old ones with their key; NULL is a key like any other."""
    match = same([F.col(f"old.{k}") for k in keys], [F.col(f"new.{k}") for k in keys])
    return old.alias("old").join(new.alias("new"), match, "left_anti").unionByName(new)


Merge = Callable[[DataFrame, DataFrame, list[str]], DataFrame]


def merged_files(
    df: DataFrame, path: str, before: Version, table: str, keys: list[str], buckets: int | Column = BUCKETS, merge: Merge = replace_by_key
) -> dict:
    """The table after merging `df`, which has one row per key, with new files for the buckets that `df` touches only.

    Deals by a hash of the keys or, given a column expression of them, by its integer value, so that a merge of recent
    keys touches few buckets. A table stays with the number of buckets that it was made with.
    """
    known = before.tables.get(table, {})
    if not isinstance(buckets, Column):
        buckets = known.get("buckets", buckets)
    bucket = F.coalesce(buckets, F.lit(-1)) if isinstance(buckets, Column) else _bucket(keys, buckets)
    # Read twice, for the buckets and for the rows, so computed once.
    df = materialise(df)
    touched = {r[0] for r in df.select(bucket.cast("int")).distinct().collect()}
    untouched, old = [], []
    for file in before.files(table):
        (old if file[1] in touched else untouched).append(file)
    after = merge(_scan(df.sparkSession, path, before, table, old), df, keys) if old else df
    files = new_files(after.withColumn(BUCKET, bucket.cast("int")), path) if touched else []
    made = table_of(df, [*untouched, *files])
    return made if isinstance(buckets, Column) else {**made, "buckets": buckets}


def upsert_rows(
    df: DataFrame,
    path: str,
    keys: list[str],
    table: str = ROWS,
    buckets: int | Column = BUCKETS,
    merge: Merge = replace_by_key,
    batch: tuple[str, int] | None = None,
) -> Version:
    """Rows of `df`, one per key, replace those with the same keys and are added where there are none."""
    spark = df.sparkSession
    before = stored_version(spark, path)
    if _done(before, batch):
        return before
    return commit(spark, path, before, {table: merged_files(df, path, before, table, keys, buckets, merge)}, _noted(batch))


def increment_stored(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    key: str,
    order: list[str],
    value: str,
    step: int = 1,
    stamp: Column | None = None,
    stamp_col: str = "lastUpdate",
    table: str = ROWS,
    batch: tuple[str, int] | None = None,
) -> Version:
    """`increment_first` on a stored table: files without a row to change are neither read whole nor written.

    The search for the first row of each key reads `key` and `order` only and skips keys without an update. With `stamp`
    the table has to have `stamp_col`.
    """
    before = stored_version(spark, path)
    if _done(before, batch):
        return before
    rows = _scan(spark, path, before, table)
    if not before.files(table):
        return commit(spark, path, before, {}, _noted(batch))
    # Where a file lies is carried along with the least order; the place below `data` names it.
    place = F.regexp_extract(F.col("_metadata.file_path"), r"(data/[^/]+(?:/_bucket=[^/]+)?/[^/]+)$", 1)
    found = increment_targets(rows.withColumn("_place", place), updates, key, order, ["_place"], only_updated=True)
    targets = materialise(found)
    touched = {r[0] for r in targets.select("_place").distinct().collect()}
    stay, go = [], []
    for file in before.files(table):
        (go if file[0] in touched else stay).append(file)
    if not go:
        return commit(spark, path, before, {}, _noted(batch))
    changed = apply_increments(_scan(spark, path, before, table, go), targets.drop("_place"), key, order, value, step, stamp, stamp_col)
    if any(bucket is not None for _, bucket in go):
        raise ValueError("a table that is dealt by keys is changed with upsert_rows")
    known = before.tables[table]
    return commit(spark, path, before, {table: {**known, "files": [*stay, *new_files(changed, path)]}}, _noted(batch))


def expire_versions(spark: SparkSession, path: str, versions: int = KEPT_VERSIONS, seconds: float = KEPT_SECONDS) -> int:
    """Delete versions that are neither among the last `versions` nor younger than `seconds`, and the data files that
    only they name; returns their number. Frames over such a version cannot be read afterwards."""
    numbers = sorted(_numbers(spark, path))
    texts = {n: json.loads(read_text(spark, f"{path}/versions/{n:012d}.json")) for n in numbers[:-versions]}
    old = [n for n, text in texts.items() if text["at"] < time.time() - seconds]
    if not old:
        return 0
    # Versions expire from the oldest on, so a file that the oldest one that stays does not name is named by none.
    old = numbers[: len(old)]
    kept = stored_version(spark, path, numbers[len(old)])
    needed = {place for table in kept.tables.values() for place, _ in table["files"]}
    for n in old:
        for place in {place for table in texts[n]["tables"].values() for place, _ in table["files"]} - needed:
            delete_path(spark, f"{path}/{place}")
        delete_path(spark, f"{path}/versions/{n:012d}.json")
    return len(old)


def write_upserts(
    df: DataFrame,
    path: str,
    checkpoint: str,
    keys: list[str],
    buckets: int | Column = BUCKETS,
    trigger: dict | None = None,
    versions: int = KEPT_VERSIONS,
    seconds: float = KEPT_SECONDS,
) -> StreamingQuery:
    """Changed rows of an aggregate go into a stored table by their keys; read it with `read_stored`.

    A batch writes the buckets that it touches, and one that is replayed after its commit writes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_rows(batch, path, keys, buckets=buckets, batch=("stream", batch_id))
        expire_versions(batch.sparkSession, path, versions, seconds)

    writer = df.writeStream.option("checkpointLocation", checkpoint).outputMode("update")
    return (writer.trigger(**trigger) if trigger else writer).foreachBatch(write).start()


def store_exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/versions") and stored_version(spark, path).number >= 0
