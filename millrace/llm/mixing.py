"""Mixing sources by temperature.

Shares of tokens are raised to an exponent between 0 (all sources alike) and 1 (as they come) and normalised. The
exponent is bisected to meet a target: the least one that repeats no source more often than a limit, or the largest
one whose mixture has at least a given entropy. A source's part of the token budget is then laid out as epochs, each
a new permutation of the source's blocks and of the documents in a block; the last epoch ends where the budget does.

A source is never ordered as a whole. Blocks are dealt by a hash, running sums go over blocks (at most MAX_BLOCKS a
source) and within a block, so that a source with a third of all rows is spread over as many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.base import WORD, free_names, located, placed, ready, whole_text
from millrace.plans.sizing import sized_join

BLOCK_TOKENS = 50_000
MAX_BLOCKS = 4096
HALVINGS = 30
PLACES = 6
# Seeds of the hashes that deal documents to blocks, order blocks, and order documents.
DEAL, ORDER_BLOCKS, ORDER_DOCS = 91, 92, 93


@dataclass(frozen=True)
class Target:
    """Tokens wanted, as a part of those there are, and one of the two limits on the mixture."""

    budget: float = 1.0
    max_repeats: float | None = None
    min_entropy: float | None = None

    def __post_init__(self) -> None:
        if (self.max_repeats is None) == (self.min_entropy is None):
            raise ValueError("give max_repeats or min_entropy")


def token_sizes(docs: DataFrame, text: str = "text", source: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source (empty if null), n_tokens (words of the whole text, 0 if null) and the columns to carry."""
    name = F.coalesce(F.col(source).cast("string"), F.lit(""))
    words = F.regexp_count(whole_text(text), F.lit(WORD)).cast("long")
    return docs.select(F.col("doc_id"), name.alias("source"), words.alias("n_tokens"), *carry)


def exponent(totals: DataFrame, target: Target) -> float:
    """Bisect the exponent over the sources' token totals (column t); the driver gets one number.

    If even the extreme exponent misses the target it is returned: 1 for a budget that no mixture meets within
    max_repeats, 0 for an entropy above that of equal shares.
    """
    row = totals.filter("t > 0").agg(F.array_sort(F.collect_list(F.col("t").cast("double"))).alias("ts"), F.sum("t").alias("total"))

    def power(t: Column, at: Column) -> Column:
        return F.pow(t / F.col("total"), at)

    def lower(at: Column) -> Column:
        """Whether the exponent may go below `at`."""
        z = F.aggregate("ts", F.lit(0.0), lambda a, t: a + power(t, at))
        if target.max_repeats is not None:
            repeats = F.array_max(F.transform("ts", lambda t: power(t, at) / t)) / z * (F.col("total") * target.budget)
            return repeats <= target.max_repeats
        logs = F.aggregate("ts", F.lit(0.0), lambda a, t: a + power(t, at) * F.log(power(t, at)))
        return F.log(z) - logs / z < target.min_entropy

    def halve(s: Column, _) -> Column:
        mid = (s["lo"] + s["hi"]) / 2
        return F.when(lower(mid), F.struct(s["lo"].alias("lo"), mid.alias("hi"))).otherwise(F.struct(mid.alias("lo"), s["hi"].alias("hi")))

    start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), start, halve)
    scale = float(10**PLACES)
    end = F.ceil(found["hi"] * scale) if target.max_repeats is not None else F.floor(found["lo"] * scale)
    return row.select((end / scale).alias("at")).first().at or 0.0


def quotas(totals: DataFrame, at: float, budget: float) -> DataFrame:
    """Per source its tokens t, whole epochs, rest of the last epoch, and number of blocks."""
    share = F.pow(F.col("t") / F.col("_total"), F.lit(at))
    sums = totals.filter("t > 0").agg(F.sum("t").alias("_total")).first()
    if sums["_total"] is None:
        return totals.filter("t > 0").select("source", "t", *[F.lit(1).cast("long").alias(c) for c in ("blocks", "epochs", "rest")])
    shares = totals.filter("t > 0").withColumn("_total", F.lit(sums["_total"])).withColumn("share", share)
    z = shares.agg(F.sum("share")).first()[0]
    quota = F.floor(F.round(F.col("share") / F.lit(z) * (F.col("_total") * F.lit(budget)), 3)).cast("long")
    blocks = F.least(F.lit(MAX_BLOCKS), F.ceil(F.col("t") / BLOCK_TOKENS)).cast("long")
    return shares.select("source", "t", quota.alias("q"), blocks.alias("blocks")).select(
        "source", "t", "blocks", F.floor(F.col("q") / F.col("t")).alias("epochs"), (F.col("q") % F.col("t")).alias("rest")
    )


def mix(docs: DataFrame, target: Target, text: str = "text", source: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per use of a document: doc_id, source, n_tokens, epoch, block_order, doc_order, and columns to carry.

    The order of a source's stream is (epoch, block_order, doc_order); no source gets more tokens than its part of
    the budget, and misses it by less than the document that did not fit. Null text is empty; a source without words
    is left out; a null source is the source named ""; rows that repeat a document are used side by side.
    """
    ready(docs.sparkSession)
    sizes = token_sizes(docs, text, source, carry).checkpoint()
    totals = sizes.groupBy("source").agg(F.sum("n_tokens").alias("t")).checkpoint()
    parts = quotas(totals, exponent(totals, target), target.budget)
    parts = F.broadcast(parts.coalesce(1)) if totals.count() <= 100_000 else parts
    rows = sizes.join(parts, "source").withColumn("block", placed(DEAL, "doc_id") % F.col("blocks"))
    rows = rows.select("doc_id", "source", "n_tokens", "block", *carry)
    blocks = rows.groupBy("source", "block").agg(F.sum("n_tokens").alias("size")).join(parts, "source")
    blocks = blocks.select("source", "block", "size", "epochs", "rest", F.explode(F.sequence(F.lit(0).cast("long"), "epochs")).alias("epoch"))
    order = Window.partitionBy("source", "epoch").orderBy(placed(ORDER_BLOCKS, "epoch", "source", "block"), "block")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.select("*", before.alias("before"), F.row_number().over(order).cast("long").alias("block_order"))
    space = F.when(F.col("epoch") < F.col("epochs"), F.col("size")).otherwise(F.col("rest") - F.col("before"))
    blocks = blocks.withColumn("space", space).filter("epoch < epochs or space > 0")
    blocks = blocks.select("source", "block", "epoch", "block_order", "space")
    used = sized_join(rows, blocks, ["source", "block"], "inner")
    inside = Window.partitionBy("source", "epoch", "block").orderBy(placed(ORDER_DOCS, "epoch", "doc_id"), "doc_id", "n_tokens")
    running = F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    used = used.select("*", running.alias("running"), F.row_number().over(inside).cast("long").alias("doc_order"))
    return used.filter("running <= space").select("doc_id", "source", "n_tokens", "epoch", "block_order", "doc_order", *carry)


def mix_rows(docs: DataFrame, target: Target, text: str = "text", source: str = "source") -> DataFrame:
    """The rows of `docs` that the mixture uses, each as often as it uses them, with the columns they have.

    A row is known by the place that it lies at, so rows that repeat an id, and rows without one, are used one by one
    and the budget holds for them as for others.
    """
    placed_rows, names = located(docs)
    uses, copy = free_names(placed_rows, "_uses", "_copy")
    counted = mix(placed_rows, target, text, source, tuple(names)).groupBy(*names).agg(F.count("*").alias(uses))
    found = sized_join(placed_rows, counted, names, "inner")
    copies = found.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(uses))))
    return copies.select(*[F.col(f"`{c}`") for c in docs.columns])


def oracle(target: Target) -> str:
    """`mix` over `documents` with a limit on repeats, as DuckDB SQL; the halvings are unrolled."""
    scale = 10**PLACES

    def at(seed: int, *columns: str) -> str:
        text = " || '|' || ".join([f"'{seed}'", *[f"coalesce({c}::VARCHAR, '')" for c in columns]])
        return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"

    chain = ["b0 AS (SELECT 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi)"]
    for k in range(HALVINGS):
        chain.append(f"""b{k + 1} AS MATERIALIZED (
    SELECT CASE WHEN r <= {target.max_repeats} THEN lo ELSE mid END AS lo, CASE WHEN r <= {target.max_repeats} THEN mid ELSE hi END AS hi
    FROM (SELECT lo, hi, mid, max(power(t / total, mid) / t) / sum(power(t / total, mid)) * (any_value(total) * {target.budget}) AS r
        FROM s, (SELECT lo, hi, (lo + hi) / 2 AS mid FROM b{k}) GROUP BY lo, hi, mid))""")
    return f"""
WITH d AS MATERIALIZED (
    SELECT doc_id, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n_tokens FROM documents),
s AS MATERIALIZED (
    SELECT source, sum(n_tokens)::BIGINT AS t, (sum(sum(n_tokens)) OVER ())::DOUBLE AS total
    FROM d GROUP BY source HAVING sum(n_tokens) > 0),
{', '.join(chain)},
w AS (SELECT source, t, total, power(t / total, (SELECT ceil(hi * {scale}) / {scale} FROM b{HALVINGS})) AS share FROM s),
q AS (SELECT source, t, floor(round(share / (SELECT sum(share) FROM w) * (total * {target.budget}), 3))::BIGINT AS q,
    least({MAX_BLOCKS}, ceil(t / {BLOCK_TOKENS}))::BIGINT AS blocks FROM w),
p AS MATERIALIZED (SELECT source, t, blocks, q // t AS epochs, q % t AS rest FROM q),
r AS MATERIALIZED (SELECT doc_id, source, n_tokens, {at(DEAL, 'doc_id')} % blocks AS block FROM d JOIN p USING (source)),
e AS (
    SELECT source, block, size, epochs, rest, unnest(range(0, epochs + 1)) AS epoch
    FROM (SELECT source, block, sum(n_tokens)::BIGINT AS size FROM r GROUP BY ALL) JOIN p USING (source)),
o AS (
    SELECT *, coalesce(sum(size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
        row_number() OVER o AS block_order
    FROM e WINDOW o AS (PARTITION BY source, epoch ORDER BY {at(ORDER_BLOCKS, 'epoch', 'source', 'block')}, block)),
k AS (
    SELECT source, block, epoch, block_order, CASE WHEN epoch < epochs THEN size ELSE rest - before END AS space
    FROM o WHERE epoch < epochs OR rest - before > 0),
u AS (
    SELECT doc_id, source, n_tokens, epoch, block_order, space,
        sum(n_tokens) OVER (i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running, row_number() OVER i AS doc_order
    FROM r JOIN k USING (source, block)
    WINDOW i AS (PARTITION BY source, epoch, block ORDER BY {at(ORDER_DOCS, 'epoch', 'doc_id')}, doc_id, n_tokens))
SELECT doc_id, source, n_tokens, epoch, block_order, doc_order FROM u WHERE running <= space
"""
