"""Serving view over a batch layer and a speed layer.

Both layers store counts and sums, never averages, and share one half-open cut in time, so that merging them
equals computing over everything. Kept in one store, both move to a new cut in one version (`hand_over`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.sinks.stored import (
    ConcurrentChange,
    commit,
    expire_versions,
    new_files,
    read_stored,
    stored_version,
    table_of,
    upsert_rows,
)

BATCH, SPEED = "batch_view", "speed_view"
SLOT = "slot"
# Attempts of a writer that another one has come before.
ATTEMPTS = 20


def partial_aggregate(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mergeable part of the view: rows, non-NULL values and their sum per key."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"), F.count(value).alias("n_values"), F.sum(value).alias("total")
    )


def serving_view(batch: DataFrame, speed: DataFrame, keys: list[str]) -> DataFrame:
    """Count, total and average per key of both layers' partials together."""
    merged = batch.unionByName(speed).groupBy(*keys).agg(
        F.sum("n").alias("count"), F.sum("total").alias("total"), F.sum("n_values").alias("_values")
    )
    average = F.try_divide("total", "_values")
    return merged.withColumn("average", average).drop("_values")


def add_partials(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Partials of both together, one row per key."""
    sums = [F.sum(c).alias(c) for c in ("n", "n_values", "total")]
    return old.unionByName(new).groupBy(*keys).agg(*sums)


def start_speed_layer(
    stream: DataFrame, path: str, checkpoint: str, keys: list[str], value: str, slot: Column, trigger: dict | None = None
) -> StreamingQuery:
    """Keep partials per key and slot of time, a whole number, in the store at `path`.

    Slots are folders of their own, so a batch writes those of its own times, and a hand-over drops whole ones.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        added = partial_aggregate(batch.withColumn(SLOT, F.coalesce(slot, F.lit(-1)).cast("int")), [*keys, SLOT], value)
        for attempt in range(ATTEMPTS):
            try:
                upsert_rows(added, path, [*keys, SLOT], SPEED, F.col(SLOT), add_partials, batch=("speed", batch_id))
                break
            except ConcurrentChange:
                if attempt == ATTEMPTS - 1:
                    raise
        expire_versions(batch.sparkSession, path)

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(on_batch)
    return (writer.trigger(**trigger) if trigger else writer).start()


def hand_over(spark: SparkSession, path: str, events: DataFrame, keys: list[str], value: str, slot: Column, cut: int) -> None:
    """Move the cut: the batch view of all `events` before slot `cut`, and the speed view without those slots.

    `events` are the rows that the stream has taken in. Batch view, speed view and cut change in one version, so a
    reader sees every row once at any time. Rows before the cut that come later stay in the speed view until the next
    hand-over. If the stream has added a batch meanwhile, everything is computed again.
    """
    slotted = F.coalesce(slot, F.lit(-1))
    for attempt in range(ATTEMPTS):
        before = stored_version(spark, path)
        batch = partial_aggregate(events.filter(slotted < cut), keys, value)
        changed = {BATCH: table_of(batch, new_files(batch, path))}
        if SPEED in before.tables:
            later = [file for file in before.files(SPEED) if file[1] >= cut]
            changed[SPEED] = {**before.tables[SPEED], "files": later}
        try:
            commit(spark, path, before, changed, {"cut": cut})
            return
        except ConcurrentChange:
            if attempt == ATTEMPTS - 1:
                raise


def read_view(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The serving view of one version of the store; raises if neither layer has been written."""
    version = stored_version(spark, path)
    layers = [read_stored(spark, path, name, version.number).drop(SLOT) for name in (BATCH, SPEED) if name in version.tables]
    if not layers:
        raise FileNotFoundError(f"no view in {path}")
    return serving_view(layers[0], layers[-1] if len(layers) > 1 else layers[0].limit(0), keys)
