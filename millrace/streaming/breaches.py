"""Consecutive breaches on a stream, with state by key.

Inside a micro-batch the batch operator finds the hits, with hot keys split over tasks. What a key's earlier batches
have to do with it is told by a row per key: how many of its rows, and whether all of them, are breaches, and the run
that its last rows end with. These rows, which Spark has reduced from at most n first and n last rows of a key, go
through a stateful stream of their own. Its state store has one row for each key whose last reading was a breach, and a
batch touches the rows of its own keys only, however many are open. The stream tells the run that each key came with,
which decides about the run at the beginning of the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from millrace.operators.runs import consecutive_breaches, leading_rows, run_edges
from millrace.plans.sizing import GROUP_ROWS
from millrace.session import delete_path
from millrace.sinks.streams import finished_batches, write_batch

EDGES = "key STRING, batch BIGINT, n_rows INT, all_breaches BOOLEAN, last_run INT"
EDGE_COLUMNS = ["key", "batch", "n_rows", "all_breaches", "last_run"]
RUNS = "key STRING, batch BIGINT, before INT"
# Groups that keys are stepped in: a call of the step for each key would cost milliseconds. A key never changes its slot.
SLOTS = 4096
# Batches whose edges and runs stay next to the checkpoint.
HISTORY = 3


def carry_runs(n: int) -> StatefulProcessor:
    """The step of the state: per key and batch the run before it, unless 0, then the run after it is kept, unless 0.

    It is called for a slot of keys; each key of the slot has an entry of its own in the state, which is a row of the store.
    """

    # Defined here, the class goes to the workers by value, as functions do.
    class CarryRuns(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.runs = handle.getMapState("runs", "key STRING", "run INT")

        def handleInputRows(self, slot, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
            found = []
            edges = sorted(row for frame in rows for row in zip(*(frame[c].tolist() for c in EDGE_COLUMNS)))
            for key, batches in groupby(edges, itemgetter(0)):
                (kept,) = self.runs.getValue((key,)) or (0,)
                run = kept
                for _, batch, n_rows, all_breaches, last_run in batches:
                    if run:
                        found.append((key, batch, run))
                    run = min(n, run + n_rows) if all_breaches else last_run
                if run and run != kept:
                    self.runs.updateValue((key,), (run,))
                elif kept and not run:
                    self.runs.removeKey((key,))
            if found:
                yield pd.DataFrame(found, columns=["key", "batch", "before"])

    return CarryRuns()


def drain_runs(spark: SparkSession, folder: str, n: int) -> None:
    """Let the stateful stream take in the edges it has not seen; it goes on from its own checkpoint."""
    edges = spark.readStream.schema(EDGES).parquet(f"{folder}/edges/batch_id=*")
    in_slots = edges.withColumn("slot", F.pmod(F.xxhash64("key"), F.lit(SLOTS)))
    runs = in_slots.groupBy("slot").transformWithStateInPandas(carry_runs(n), RUNS, "append", "none")

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, f"{folder}/runs", batch_id)

    writer = runs.writeStream.queryName("open_runs").option("checkpointLocation", f"{folder}/state")
    writer.trigger(availableNow=True).foreachBatch(write).start().awaitTermination()


def start_breach_stream(
    stream: DataFrame,
    keys: list[str],
    order: list[str],
    breach: Column,
    path: str,
    checkpoint: str,
    n: int = 3,
    trigger: dict | None = None,
    group_rows: int = GROUP_ROWS,
    history: int = HISTORY,
) -> StreamingQuery:
    """Write the rows that are the `n`-th breach in a row of their key to `path`.

    Rows are ordered by `order` within a batch; batches follow each other as they arrive. A batch that is replayed
    finds its edges written and taken in, and gets the same runs.
    """
    spark, folder = stream.sparkSession, f"{checkpoint}/open_runs"
    as_text = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.DISK_ONLY)
        try:
            edges = run_edges(batch, keys, order, breach, n)
            marked = edges.select(as_text.alias("key"), F.lit(batch_id).cast("long").alias("batch"), "n_rows", "all_breaches", "last_run")
            write_batch(marked, f"{folder}/edges", batch_id)
            drain_runs(spark, folder, n)
            runs = finished_batches(spark, f"{folder}/runs").filter(F.col("batch") == batch_id).select("key", "before")
            # Runs that the key's first row begins are decided by what came before.
            first = leading_rows(batch, keys, order, breach, n).withColumn("key", as_text).join(runs, "key", "left")
            before = F.coalesce("before", F.lit(0))
            completes = (before < n) & (F.col("_position") == n - before)
            inner = consecutive_breaches(batch, keys, order, breach, n, group_rows, open_start=True)
            write_batch(inner.unionByName(first.filter(completes).select(*batch.columns)), path, batch_id)
        finally:
            batch.unpersist()
        if batch_id >= history:
            for part in ("edges", "runs"):
                delete_path(spark, f"{folder}/{part}/batch_id={batch_id - history}")

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(on_batch)
    return (writer.trigger(**trigger) if trigger else writer).start()


def read_breaches(spark: SparkSession, path: str) -> DataFrame:
    """All rows the stream has reported so far."""
    return finished_batches(spark, path).drop("batch_id")
