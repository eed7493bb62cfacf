"""Choices that depend on how large or how skewed the data is, made from measurements."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import materialise, plan_bytes, size_setting

BROADCAST_BYTES = 64 << 20
ROW_OVERHEAD = 64
# Cells of the sketch of large groups, and the size of a row that is taken for its width.
SKETCH_CELLS, MAX_SKETCH_CELLS, LEAST_ROW_BYTES = 1 << 14, 1 << 22, 16
# Rows of one key that a single task may sort before the key is split.
GROUP_ROWS = 2_000_000


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of what a broadcast of `df` holds: the rows as JSON text plus row and hash overhead."""
    row = F.octet_length(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})) + ROW_OVERHEAD
    return df.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]


def small_by_estimate(df: DataFrame) -> bool:
    """Whether Catalyst's estimate is below Spark's own broadcast threshold."""
    threshold = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return plan_bytes(df) <= size_setting(threshold)


def broadcastable(side: DataFrame) -> DataFrame | None:
    """`side` in a form that joins without shuffling the other frame, or None if it is too large for that.

    A side that is small by estimate is left for Spark to broadcast; any other is measured and hinted.
    """
    if small_by_estimate(side):
        return side
    return F.broadcast(side) if measured_bytes(side) <= BROADCAST_BYTES else None


def same(left: list[Column], right: list[Column]) -> Column:
    """Null-safe equality of two column lists."""
    return reduce(Column.__and__, (a.eqNullSafe(b) for a, b in zip(left, right, strict=True)))


def sized_join(df: DataFrame, side: DataFrame, on: list[str] | Column, how: str) -> DataFrame:
    """Join a large frame with an aggregated side that has at most one row per join key.

    A side that is small by estimate goes in as it is and Spark broadcasts it. Otherwise it is computed
    once into the shared folder and measured there. If it fits, the large frame is not shuffled at all; if
    not, both sides reach the join through plain exchanges, the form in which AQE splits a hot key of the
    large frame.
    """
    if not small_by_estimate(side):
        side = materialise(side)
        side = F.broadcast(side) if measured_bytes(side) <= BROADCAST_BYTES else side
    return df.join(side, on, how)


def sketch_width(rows_bytes: int, limit: int) -> int:
    """Cells of the sketch: enough that a cell of small groups stays well below `limit` rows."""
    cells = SKETCH_CELLS
    while cells < MAX_SKETCH_CELLS and rows_bytes // LEAST_ROW_BYTES // cells > limit // 8:
        cells *= 2
    return cells


def oversized_groups(df: DataFrame, keys: list[str], limit: int, cells: int | None = None) -> DataFrame:
    """Keys with more than `limit` rows and their `_rows`; at most total rows / limit of them.

    Found in a sketch first: rows are counted by a hash of their keys in a bounded number of cells, the only thing that
    every row goes through. A key with more than `limit` rows makes its cell exceed it, so none is missed; keys are
    counted one by one only in the few cells that do, and not at all if there is none.
    """
    cell = F.pmod(F.xxhash64(*keys), F.lit(cells or sketch_width(plan_bytes(df), limit)))
    full = df.groupBy(cell.alias("_cell")).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > limit).select("_cell")
    full = materialise(full)
    if full.isEmpty():
        return df.select(*keys, F.lit(0).cast("long").alias("_rows")).limit(0)
    suspects = df.select(*keys).join(broadcastable(full) or full, cell == F.col("_cell"), "left_semi")
    return suspects.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > limit)
