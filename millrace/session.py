"""Session settings and the shared folder that checkpoints and scratch tables live in."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Session-level settings that results or plan shapes depend on; all can be set on a running session.
SETTINGS = {
    # ISO strings and TIMESTAMP_NTZ columns carry no zone, so the zone is pinned.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Per-group limits stay map-side (WindowGroupLimit) up to this k instead of the default 1000.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
    # A table with a multiple of the other's buckets is read with as many as the other, rather than shuffled.
    "spark.sql.bucketing.coalesceBucketsInJoin.enabled": "true",
    # Bloom filters of a join's key set, of 8 MB for up to four million keys, are worth a pass over sets up to this size.
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "67108864",
    # Stream state on executor disk rather than the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

MAX_SPLIT_BYTES = 1 << 30
MAX_TASKS = 200_000
SHUFFLE_TARGET_BYTES = 256 << 20
MAX_SHUFFLE_WIDTH = 20_000
MAX_STREAM_WIDTH = 2_000
# Scratch paths handed out and not yet released.
_SCRATCH: list[str] = []


def configure(spark: SparkSession) -> SparkSession:
    """Apply SETTINGS to a session that somebody else created."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(
    app: str, master: str | None = None, shuffle_width: int | None = None, driver_memory: str | None = None
) -> SparkSession:
    """A session with SETTINGS; without `master` the one given by spark-submit is used."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        # Checkpointed frames are removed from the shared folder once nothing refers to them.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_width:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_width))
    return configure(builder.getOrCreate())


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate; no job runs. For a file scan it is the size of the files.

    Joins multiply the estimates of their sides, so those of deep plans can have thousands of digits, more than
    Python reads as a number; they count as 2 to the 62.
    """
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except ValueError:
        return 1 << 62


def size_setting(text: str) -> int:
    """A Spark size setting, such as `128MB` or `134217728b`, in bytes."""
    number = text.strip().lower().removesuffix("b")
    scale = {"k": 10, "m": 20, "g": 30, "t": 40}
    return int(number[:-1]) << scale[number[-1]] if number[-1] in scale else int(number)


def _asked(spark: SparkSession, name: str) -> str:
    """What the session itself asks for in a setting that `_fit` changes."""
    current = spark.conf.get(name)
    if current != spark.conf.get(f"millrace.fitted.{name}", None):
        spark.conf.set(f"millrace.asked.{name}", current)
    return spark.conf.get(f"millrace.asked.{name}")


def _fit(spark: SparkSession, name: str, value: int | str) -> None:
    spark.conf.set(name, str(value))
    spark.conf.set(f"millrace.fitted.{name}", str(value))


def fit_to_inputs(spark: SparkSession, *inputs: DataFrame, streaming: bool = False) -> tuple[int, int]:
    """Size scan splits and shuffle widths for a query over `inputs`; returns both.

    Splits grow so that no scan has more than MAX_TASKS tasks. AQE starts its shuffles with enough
    partitions for the inputs and merges small ones back. A stream keeps the width it starts with, and a state
    store per partition, so it gets the width itself, up to MAX_STREAM_WIDTH. Nothing falls below what the
    session asks for. MAX_SHUFFLE_WIDTH is where map x reduce blocks start to cost more than larger partitions.
    """
    split_asked = _asked(spark, "spark.sql.files.maxPartitionBytes")
    width_asked = _asked(spark, "spark.sql.shuffle.partitions")
    total = sum(plan_bytes(df) for df in inputs)
    split = max(size_setting(split_asked), min(total // MAX_TASKS, MAX_SPLIT_BYTES))
    limit = MAX_STREAM_WIDTH if streaming else MAX_SHUFFLE_WIDTH
    width = max(int(width_asked), min(total // SHUFFLE_TARGET_BYTES, limit))
    _fit(spark, "spark.sql.files.maxPartitionBytes", split)
    _fit(spark, "spark.sql.shuffle.partitions", width if streaming else width_asked)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(width))
    return split, width


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach: `spark.checkpoint.dir`, or a new local one in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    in_use = spark.sparkContext.getCheckpointDir()
    if in_use:
        return in_use.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    fresh = tempfile.mkdtemp(prefix="millrace-")
    spark.sparkContext.setCheckpointDir(fresh)
    return fresh


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that no earlier run has used; `release_scratch` deletes it."""
    path = f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete everything this process wrote under scratch paths; returns the number of paths.

    Frames that read from such a path, as those of the layout and stream queries do, cannot be used afterwards.
    """
    released = 0
    while _SCRATCH:
        delete_path(spark, _SCRATCH.pop())
        released += 1
    return released


def materialise(df: DataFrame) -> DataFrame:
    """Compute `df` once into the shared folder and cut its lineage."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is on; nothing happens if it is absent."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, on whatever file system it is on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return sorted(status.getPath().toString() for status in found or [])


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def matching_sizes(spark: SparkSession, pattern: str) -> dict[str, int]:
    """Sizes in bytes of the files that match a glob pattern, from the listing alone."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return {status.getPath().toString(): status.getLen() for status in found or []}


def plain_files(spark: SparkSession, path: str) -> list[str] | None:
    """The data files of a file or flat folder, from one listing and no job; None if it has folders or a pattern."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    home = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if any(sign in path for sign in "*?[{") or not home.exists(target):
        return None
    seen = [s for s in home.listStatus(target) if s.getPath().getName()[0] not in "_."]
    return None if any(s.isDirectory() for s in seen) else sorted(s.getPath().toString() for s in seen)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file on whatever file system `path` is on; replaces one that is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file from whatever file system it is on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file to a name that must be free; False, and nothing renamed, if it is taken."""
    fs = spark._jvm.org.apache.hadoop.fs
    source, target = fs.Path(source), fs.Path(target)
    home = target.getFileSystem(spark._jsc.hadoopConfiguration())
    context = fs.FileContext.getFileContext(home.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        context.rename(home.makeQualified(source), home.makeQualified(target), options)
    except Py4JJavaError as failed:
        if "FileAlreadyExistsException" not in str(failed.java_exception.getClass().getName()):
            raise
        return False
    return True


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Let AQE plan what is run meanwhile. The session of a stream has it off, and with it what plans rely on here:
    REBALANCE, small partitions merged, hot keys of joins split. The batch itself is planned before its step is called.
    """
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
