"""Consecutive breaches: the n-th breach in a row of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from millrace.plans.sizing import GROUP_ROWS, broadcastable, oversized_groups, same
from millrace.session import MAX_SHUFFLE_WIDTH, materialise


def consecutive_breaches(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    breach: Column,
    n: int = 3,
    group_rows: int = GROUP_ROWS,
    open_start: bool = False,
) -> DataFrame:
    """Rows that are the `n`-th breach in a row of their key; a longer run is reported once.

    `order` must leave no ties within a key; a NULL condition is no breach. Keys are not counted unless a sketch of
    them says that some may be large. With `open_start`, a run that begins
    with the first row of its key is left out, for it may have begun before.

    Keys with up to `group_rows` rows are windowed whole. Larger ones are cut into ranges of about that many
    rows (at most MAX_SHUFFLE_WIDTH ranges), and only the `n` rows on either side of each cut are looked at
    together, so no task ever holds a hot key whole.
    """
    flagged = _flagged(df, breach)
    by_key = Window.partitionBy(*keys).orderBy(*order)
    hot = materialise(oversized_groups(flagged, keys, group_rows))
    hot_rows = hot.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    if not hot_rows:
        return flagged.withColumn("_hit", _nth(by_key, n, open_start)).filter("_hit").select(*df.columns)

    hot_keys = hot.select(*(F.col(k).alias(f"_hot_{k}") for k in keys))
    hot_keys = broadcastable(hot_keys) or hot_keys
    is_hot = same([F.col(k) for k in keys], [F.col(f"_hot_{k}") for k in keys])
    cold = flagged.join(hot_keys, is_hot, "left_anti").withColumn("_hit", _nth(by_key, n, open_start))

    in_range = Window.partitionBy(*keys, "_range").orderBy(*order)
    placed = (
        flagged.join(hot_keys, is_hot, "left_semi")
        .repartitionByRange(min(hot_rows // group_rows + 1, MAX_SHUFFLE_WIDTH), *keys, *order)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_hit", _nth(in_range, n, open_start))
        .withColumn("_head", F.lag(F.lit(1), n).over(in_range).isNull())
        .withColumn("_tail", F.lead(F.lit(1), n).over(in_range).isNull())
    )
    # Range bounds come from a sample, so what is read twice is fixed once: hits, and the rows around cuts.
    kept = materialise(placed.filter(F.col("_hit") | F.col("_head") | F.col("_tail")))
    inner = kept.filter(F.col("_hit") & ~F.col("_head"))
    # The last n rows of a range directly precede the first n of the next one.
    edges = kept.filter(F.col("_head") | F.col("_tail")).withColumn("_hit", _nth(by_key, n, open_start))
    parts = (cold.filter("_hit"), inner, edges.filter(F.col("_head") & F.col("_hit")))
    first, second, third = (part.select(*df.columns) for part in parts)
    return first.unionByName(second).unionByName(third)


def run_edges(df: DataFrame, keys: list[str], order: list[str], breach: Column, n: int = 3) -> DataFrame:
    """Per key `n_rows` up to `n`, whether `all_breaches`, and `last_run`, the breaches that its last rows are, up to `n`.

    A task sends one row and `n` more of a key, however many it holds.
    """
    flagged = _flagged(df.select("*"), breach)
    last = rank_positions(flagged, keys, [F.desc(c) for c in order], n)
    calm = F.min(F.when(F.col("_breach") == 0, F.col("_position")))
    run = F.coalesce(calm - 1, F.count("*")).cast("int").alias("last_run")
    runs = last.groupBy(*keys).agg(run, F.count("*").cast("int").alias("n_rows"))
    whole = flagged.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg((F.min("_breach") == 1).alias("all_breaches"))
    return runs.join(whole, same([F.col(k) for k in keys], [F.col(f"_{k}") for k in keys])).drop(*(f"_{k}" for k in keys))


def leading_rows(df: DataFrame, keys: list[str], order: list[str], breach: Column, n: int = 3) -> DataFrame:
    """Breaches that their key begins with, up to `n`, with their `_position` from 1 on."""
    first = rank_positions(_flagged(df, breach), keys, order, n)
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return first.withColumn("_breach", F.min("_breach").over(before)).filter(F.col("_breach") == 1).drop("_breach")


def rank_positions(df: DataFrame, keys: list[str], order: list[Column | str], n: int) -> DataFrame:
    """The first `n` rows per key with their `_position`; a task sends at most `n` rows of a key."""
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).filter(F.col("_position") <= n)


def _flagged(df: DataFrame, breach: Column) -> DataFrame:
    return df.withColumn("_breach", F.coalesce(breach, F.lit(False)).cast("int"))


def _nth(ordered: WindowSpec, n: int, open_start: bool) -> Column:
    """Whether exactly `n` breaches in a row end at a row: the last n are breaches, the one before is not."""
    last_n = F.sum("_breach").over(ordered.rowsBetween(1 - n, 0))
    before = F.coalesce(F.lag("_breach", n).over(ordered), F.lit(int(open_start)))
    return (last_n == n) & (before == 0)
