"""Exact deduplication as a stream with keyed state that never expires.

Each document arrives as its digest, its identifier, its length and the place its content lies at. The state, on
disk in RocksDB and checkpointed to the shared folder, has one row per digest: how many arrived, and identifier,
length and locator of the one that stays. Counting is combined before the shuffle, so that a digest that a third
of all rows share is one row per task and batch. Where a digest was hit more than once, the full bytes are compared;
documents that only share a digest are told apart by their bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import SPACE, located, ready, settings, whole_text
from millrace.plans.sizing import sized_join
from millrace.session import delete_path, scratch_path
from millrace.sinks import write_update_log

# Micro-batches that a stored table is drained in.
BATCHES = 3
# A store is open only while its task runs, for each takes some MB of local disk; batches leave their changes.
STATE = {
    "unloadOnCommit": "true",
    "rocksdb.changelogCheckpointing.enabled": "true",
    "rocksdb.boundedMemoryUsage": "true",
    "rocksdb.maxMemoryUsageMB": "256",
}
PLACE = ["__path", "__row"]


def normalised(text: str = "text") -> Column:
    """The text without white space, empty if null."""
    return F.regexp_replace(whole_text(text), f"[{SPACE}]+", "")


def sha256(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def _stays() -> Column:
    """Orders the documents of a group: most code points first, then smallest identifier, nulls last, then place."""
    return F.struct("n_chars", F.bitwise_not("doc_id").alias("not_id"), F.col("__path").alias("path"), F.col("__row").alias("row"))


def dedup_state(arrivals: DataFrame) -> DataFrame:
    """The streaming aggregate: per digest the number of arrivals and the document that stays."""
    return arrivals.groupBy("digest").agg(F.count("*").alias("n"), F.max(_stays()).alias("stays"))


def drain(arrivals: DataFrame) -> DataFrame:
    """Store arrivals, stream them through `dedup_state` in batches, and read the state's last row per digest."""
    spark = ready(arrivals.sparkSession)
    path = scratch_path(spark, "exact")
    arrivals.write.parquet(f"{path}/arrivals")
    stored = spark.read.parquet(f"{path}/arrivals")
    per_batch = max(1, -(-stored.select("_metadata.file_path").distinct().count() // BATCHES))
    stream = (
        spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", per_batch).parquet(f"{path}/arrivals")
    )
    log = f"{path}/state"
    with settings(spark, {f"spark.sql.streaming.stateStore.{name}": value for name, value in STATE.items()}):
        write_update_log(dedup_state(stream), log, f"{path}/checkpoint", {"availableNow": True}).awaitTermination()
    schema = "digest string, n bigint, stays struct<n_chars:bigint,not_id:bigint,path:string,row:bigint>, batch_id int"
    state = spark.read.schema(schema).parquet(log) if stored.take(1) else spark.createDataFrame([], schema)
    last = state.groupBy("digest").agg(F.max_by(F.struct("n", "stays"), "batch_id").alias("s")).select("digest", "s.*")
    found = stored.join(last, "digest").checkpoint()
    delete_path(spark, path)
    return found


def exact_groups(docs: DataFrame, text: str = "text", digest=sha256) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256, and its place (__path, __row).

    Texts are equal when they are after white space is taken out; null and empty texts are equal. Of equal texts the
    longest stays, then the smallest doc_id; null ids come last; among rows that repeat an id one stays. Other
    columns are not read. `digest` is a column function from the normalised text to a string; groups come out right
    with any, because hits are checked on full bytes.
    """
    return _groups(*located(docs), text, digest)


def _groups(placed: DataFrame, names: list[str], text: str, digest) -> DataFrame:
    place = [F.col(name).alias(to) for name, to in zip(names, PLACE, strict=True)]
    rows = placed.select(F.col("doc_id").cast("long"), whole_text(text).alias("_t"), normalised(text).alias("_n"), *place)
    arrivals = rows.select(
        "doc_id", digest(F.col("_n")).alias("digest"), F.length("_t").cast("long").alias("n_chars"),
        sha256(F.col("_n")).alias("text_sha256"), *PLACE,
    )
    found = drain(arrivals)
    # Full bytes of the hits: all texts of a digest are equal if the smallest is the largest.
    hits = found.filter("n > 1").select("digest").distinct()
    content = rows.select("doc_id", "_t", "_n", digest(F.col("_n")).alias("digest"), *PLACE)
    content = sized_join(content, hits, ["digest"], "left_semi")
    clash = content.groupBy("digest").agg((F.min("_n") == F.max("_n")).alias("same")).filter(~F.col("same"))
    clash = clash.select("digest").checkpoint()
    if not clash.isEmpty():
        found = _by_bytes(found, content, clash)
    keep = F.bitwise_not("stays.not_id")
    place = (F.col("stays.path") == F.col("__path")) & (F.col("stays.row") == F.col("__row"))
    return found.select(
        "doc_id", keep.alias("keep_id"), F.col("n").alias("group_size"), place.alias("kept"), "text_sha256", *PLACE
    )


def _by_bytes(found: DataFrame, content: DataFrame, clash: DataFrame) -> DataFrame:
    """The groups of clashing digests, made on the bytes themselves."""
    texts = content.join(clash, "digest", "left_semi").withColumn("n_chars", F.length("_t").cast("long"))
    groups = texts.groupBy("digest", "_n").agg(F.count("*").alias("n"), F.max(_stays()).alias("stays"))
    told = texts.join(groups, ["digest", "_n"]).select(*PLACE, "n", "stays")
    fixed = found.join(clash, "digest", "left_semi").drop("n", "stays").join(told, PLACE)
    return found.join(clash, "digest", "left_anti").unionByName(fixed.select(found.columns))


def exact_dedup(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with the columns they have; see `exact_groups`."""
    placed, names = located(docs)
    gone = _groups(placed, names, text, sha256).filter(~F.col("kept"))
    gone = gone.select(*[F.col(at).alias(name) for at, name in zip(PLACE, names, strict=True)])
    return sized_join(placed, gone, names, "left_anti").drop(*names)
