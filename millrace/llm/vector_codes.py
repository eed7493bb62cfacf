"""Product codes of vectors by dual-tree Lloyd, in whole numbers throughout.

A vector's components become integers and are cut into parts; each position of a part has a codebook, and a part's code
is its nearest entry. Lloyd's rounds assign every part and move each entry to the floored mean of its parts.

The vectors are dealt into blocks once. In a block, every part position has a tree over the parts, halved along the widest
side of each node, and is stored in the tree's order, so that a node is a stretch of it. A round walks this tree and one
over the entries together: a pair of nodes is dropped once its boxes lie farther apart than some other entry node is sure
to reach. A node of parts that is left with one entry is assigned whole, by its cached sum and count; leaves with several
entries left are compared with those by exact distances. The bounds are integers too, and only entries that are strictly
farther are dropped, so ties go to the lower index as in a full comparison.

A round sends the driver one sum per entry and component, and the codebooks (256 vectors' worth) go out with the tasks;
neither grows with the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from millrace.llm.base import Shelf, ready
from millrace.plans.sizing import sized_join

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
# Components of a block's vectors, and vectors in a leaf of a tree.
BLOCK_VALUES = 1 << 18
LEAF = 32
# Integers below this have squared distances that 64 bits hold, for parts of up to 8,192 components.
SMALL = 1 << 24
LARGEST_LONG = (1 << 63) - 1
# Numbers that the bounds of pairs of nodes take at a time.
PAIR_VALUES = 1 << 20


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """floor(1024 x), as 64-bit integers or, where those could overflow later on, as Python's."""
    values = np.asarray(values, np.float64)
    if not values.size or np.abs(values).max() < SMALL / SCALE:
        return np.floor(values * SCALE).astype(np.int64)
    exact = [(a * SCALE) // b for a, b in (x.as_integer_ratio() for x in values.ravel().tolist())]
    return fitting(np.array(exact, object).reshape(values.shape))


def fitting(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the narrower of the two forms that distances between them are exact in."""
    small = not values.size or max(abs(int(values.min())), abs(int(values.max()))) < SMALL
    return values.astype(np.int64 if small else object)


def to_bytes(values: np.ndarray) -> bytes:
    return b"n" + values.astype(np.int32).tobytes() if values.dtype == np.int64 else b"t" + ",".join(map(str, values.ravel())).encode()


def from_bytes(data: bytes, rows: int) -> np.ndarray:
    if data[:1] == b"n":
        return np.frombuffer(data, np.int32, offset=1).astype(np.int64).reshape(rows, -1)
    return np.array([int(x) for x in data[1:].split(b",")], object).reshape(rows, -1)


def cuts(n: int, level: int) -> np.ndarray:
    """Where the nodes of a level begin in the tree's order, and the end; a level halves each node of the one above."""
    return (np.arange((1 << level) + 1) * n) >> level


def depth(n: int, leaf: int) -> int:
    """The last level, at which nodes have `leaf` members or a few more, never none."""
    return max(n // leaf, 1).bit_length() - 1


def tree_order(points: np.ndarray, leaf: int) -> np.ndarray:
    """Places of the points in the order of the tree: each node is halved at the median of its widest side."""
    order = np.arange(len(points))
    for level in range(depth(len(points), leaf) if points.shape[1] else 0):
        ends, below = cuts(len(points), level), cuts(len(points), level + 1)
        for at, (a, b) in enumerate(zip(ends, ends[1:])):
            node = points[order[a:b]]
            side = node[:, int(np.argmax(node.max(axis=0) - node.min(axis=0)))]
            middle = below[2 * at + 1] - a
            # A partition is enough, but Python's integers have none.
            halves = np.argpartition(side, middle) if side.dtype == np.int64 else np.argsort(side, kind="stable")
            order[a:b] = order[a:b][halves]
    return order


class Boxes:
    """The nodes of a tree level by level: bounding boxes, and sums of members as cached statistics."""

    def __init__(self, points: np.ndarray, leaf: int) -> None:
        n, self.last = len(points), depth(len(points), leaf)
        self.ends = [cuts(n, level) for level in range(self.last + 1)]
        starts = self.ends[-1][:-1]
        self.low, self.high, self.sums = ([f.reduceat(points, starts, axis=0)] for f in (np.minimum, np.maximum, np.add))
        for _ in range(self.last):
            for kept, f in ((self.low, np.minimum), (self.high, np.maximum), (self.sums, np.add)):
                kept.insert(0, f(kept[0][::2], kept[0][1::2]))


def _bounds(boxes: Boxes, level: int, node: np.ndarray, entries: Boxes, depth: int, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance between members of pairs of nodes."""
    near, far = [], []
    step = max(1, PAIR_VALUES // max(boxes.low[0].shape[1], 1))
    for at in range(0, len(node), step):
        p, e = node[at : at + step], entry[at : at + step]
        above, below = entries.low[depth][e] - boxes.high[level][p], boxes.low[level][p] - entries.high[depth][e]
        gap, reach = np.maximum(np.maximum(above, below), 0), np.maximum(-above, -below)
        near.append((gap * gap).sum(axis=1))
        far.append((reach * reach).sum(axis=1))
    return np.concatenate(near), np.concatenate(far)


class Found:
    """Nodes assigned whole, as (level, node, entry), and the leaves left with several entries, as (node, entries)."""

    def __init__(self) -> None:
        self.whole: list[tuple[int, np.ndarray, np.ndarray]] = []
        self.unsure: list[tuple[int, np.ndarray]] = []


def descend(boxes: Boxes, entries: Boxes, order: np.ndarray) -> Found:
    """Walk both trees together. `order` has the entry at each place of the entries' tree."""
    found, level, depth = Found(), 0, 0
    node = entry = np.zeros(1, np.int64)
    while len(node):
        near, far = _bounds(boxes, level, node, entries, depth, entry)
        first = np.flatnonzero(np.diff(node, prepend=-1))
        count = np.diff(first, append=len(node))
        within = near <= np.repeat(np.minimum.reduceat(far, first), count)
        node, entry = node[within], entry[within]
        if depth == entries.last:
            ends = entries.ends[depth]
            alone = np.bincount(node)[node] == 1
            alone &= (ends[1:] - ends[:-1])[entry] == 1
            found.whole.append((level, node[alone], order[ends[entry[alone]]]))
            node, entry = node[~alone], entry[~alone]
            if level == boxes.last:
                break
        if depth < entries.last:
            node, entry, depth = np.repeat(node, 2), np.stack([2 * entry, 2 * entry + 1], axis=1).ravel(), depth + 1
        if level < boxes.last:
            # Both halves of a node take over its entries, so pairs stay sorted by node.
            first = np.flatnonzero(np.diff(node, prepend=-1))
            sizes = np.repeat(np.diff(first, append=len(node)), 2)
            source = np.arange(sizes.sum()) - np.repeat(sizes.cumsum() - sizes - np.repeat(first, 2), sizes)
            half = np.stack([2 * node[first], 2 * node[first] + 1], axis=1).ravel()
            node, entry, level = np.repeat(half, sizes), entry[source], level + 1
    ends, first = entries.ends[depth], np.flatnonzero(np.diff(node, prepend=-1))
    for a, b in zip(first, np.append(first[1:], len(node))):
        # A leaf of the entries' tree has one or two of them: its first and its last.
        left = np.concatenate([order[ends[entry[a:b]]], order[ends[entry[a:b] + 1] - 1]])
        found.unsure.append((int(node[a]), np.unique(left)))
    return found


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of points to entries, as whole numbers."""
    squares = [(x * x).sum(axis=1) for x in (points, entries)]
    return squares[0][:, None] - 2 * (points @ entries.T) + squares[1]


class Codebook:
    """Entries of one part position with the tree over them."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = fitting(entries)
        self.order = tree_order(self.entries, 1)
        self.boxes = Boxes(self.entries[self.order], 1)

    def search(self, points: np.ndarray) -> tuple[Boxes, Found]:
        boxes = Boxes(points, LEAF)
        return boxes, descend(boxes, self.boxes, self.order)

    def add_up(self, points: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
        """Add the points, in a tree's order, to sum and count of the entry that each is nearest to."""
        boxes, found = self.search(points)
        for level, node, entry in found.whole:
            np.add.at(sums, entry, boxes.sums[level][node])
            np.add.at(counts, entry, np.diff(boxes.ends[level])[node])
        ends = boxes.ends[-1]
        for node, left in found.unsure:
            members = points[ends[node] : ends[node + 1]]
            entry = left[np.argmin(distances(members, self.entries[left]), axis=1)]
            np.add.at(sums, entry, members)
            np.add.at(counts, entry, 1)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the entry that each of the points, in a tree's order, is nearest to."""
        boxes, found = self.search(points)
        index = np.zeros(len(points), np.int64)
        for level, node, entry in found.whole:
            for a, b, e in zip(boxes.ends[level][node], boxes.ends[level][node + 1], entry):
                index[a:b] = e
        ends = boxes.ends[-1]
        for node, left in found.unsure:
            a, b = ends[node], ends[node + 1]
            index[a:b] = left[np.argmin(distances(points[a:b], self.entries[left]), axis=1)]
        away = points - self.entries[index]
        return index, (away * away).sum(axis=1)


def part_cuts(dimension: int) -> list[int]:
    """Where the parts begin, and the end; of equal length where the dimension allows it."""
    return [dimension * at // PARTS for at in range(PARTS + 1)]


def _finite(vector: str) -> Column:
    fit = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(fit, F.lit(False))


def _blocks(dimension: int, label: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of id, label, vector to rows of a block: ids, labels, and per part order and points of its tree."""
    size, ends = max(1, BLOCK_VALUES // max(dimension, 1)), part_cuts(dimension)

    def block(rows: pa.Table) -> pa.RecordBatch:
        flat = rows.column(2).combine_chunks().flatten().to_numpy(zero_copy_only=False)
        points = flat.reshape(len(rows), dimension)
        trees = []
        for a, b in zip(ends, ends[1:]):
            part = whole_numbers(points[:, a:b])
            order = tree_order(part, LEAF)
            trees.append({"places": order.astype(np.int32).tobytes(), "points": to_bytes(part[order])})
        columns = [pa.array([rows.column(at).to_pylist()], pa.list_(kind)) for at, kind in ((0, pa.int64()), (1, label))]
        kind = pa.list_(pa.struct([("places", pa.binary()), ("points", pa.binary())]))
        return pa.RecordBatch.from_arrays([*columns, pa.array([trees], kind)], ["ids", "labels", "parts"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= size:
                rows = pa.Table.from_batches(held)
                yield block(rows.slice(0, size))
                held = rows.slice(size).to_batches()
        if sum(b.num_rows for b in held):
            yield block(pa.Table.from_batches(held))

    return blocks


def _round(codebooks: list[np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks to sum and count of each entry, one row per entry and task at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(c) for c in codebooks]
        sums = [np.zeros(b.entries.shape, object) for b in books]
        counts = [np.zeros(len(b.entries), np.int64) for b in books]
        for batch in batches:
            for ids, parts in zip(batch.column("ids"), batch.column("parts")):
                for at, tree in enumerate(parts.as_py()):
                    points = from_bytes(tree["points"], len(ids))
                    added = np.zeros(sums[at].shape, points.dtype)
                    books[at].add_up(points, added, counts[at])
                    sums[at] += added
        rows = [(at, e, int(n), [Decimal(int(x)) for x in sums[at][e]]) for at, c in enumerate(counts) for e, n in enumerate(c) if n]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.decimal128(38, 0))]
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", "sums"])

    return run


def _codes(codebooks: list[np.ndarray], label: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks to rows of id, label, code and error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(c) for c in codebooks]
        for batch in batches:
            for ids, labels, parts in zip(*(batch.column(c) for c in ("ids", "labels", "parts"))):
                codes, error = np.zeros((len(ids), len(books)), np.uint8), np.zeros(len(ids), object)
                for at, tree in enumerate(parts.as_py()):
                    places = np.frombuffer(tree["places"], np.int32)
                    codes[places, at], away = books[at].nearest(from_bytes(tree["points"], len(ids)))
                    error[places] += away
                error = [min(int(e), LARGEST_LONG) for e in error]
                columns = [ids.values, labels.values, pa.array([c.tobytes().hex() for c in codes]), pa.array(error, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    return run


def _moved(blocks: DataFrame, codebooks: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round; unused entries stay."""
    sums = blocks.mapInArrow(_round(codebooks), "part int, entry int, n long, sums array<decimal(38,0)>")
    counts = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"))
    totals = sums.select("part", "entry", F.posexplode("sums").alias("at", "x")).groupBy("part", "entry", "at")
    totals = totals.agg(F.sum("x").cast("decimal(38,0)").alias("total"))
    moved = [c.astype(object) for c in codebooks]
    # As many rows as the codebooks have components.
    for r in totals.join(counts, ["part", "entry"]).collect():
        moved[r.part][r.entry, r.at] = int(r.total) // r.n
    return [fitting(c) for c in moved]


def digest(codebooks: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for c in codebooks for x in c.ravel().tolist()).encode()).hexdigest()


def vector_codes(vectors: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES, vector: str = "embedding") -> DataFrame:
    """`vec_id`, `label`, `code`, `error`, `label_error` and `codebooks_sha256` of the vectors that are kept.

    Takes `vec_id`, `label` and `vector`; other columns are not read. Vectors that are null or hold a null, NaN or infinite
    component are left out, and so are those of another length than the one with the smallest vec_id. The codebooks begin
    with the `entries` smallest vec_ids (all, if there are fewer), rows that repeat an id in the order of their components,
    null ids last. Repeated rows get equal codes and count each time. A dimension that four does not divide gives parts of
    unequal length; empty tables and empty vectors are allowed. Sums are exact up to 38 digits, more raise; an error that
    does not fit a long is the largest long.
    """
    spark = ready(vectors.sparkSession, 4096)
    kept = vectors.select(F.col("vec_id").cast("long"), "label", F.col(vector).cast("array<double>").alias("vector")).filter(_finite("vector"))
    order = [F.col("vec_id").asc_nulls_last(), F.col("vector")]
    found = kept.orderBy(*order).limit(1).collect()
    dimension = len(found[0].vector) if found else 0
    kept = kept.filter(F.size("vector") == dimension)
    first = [r.vector for r in kept.orderBy(*order).limit(entries).collect()]
    start = whole_numbers(np.array(first, np.float64).reshape(len(first), dimension))
    ends = part_cuts(dimension)
    codebooks = [fitting(start[:, a:b]) for a, b in zip(ends, ends[1:])]
    label = kept.schema["label"].dataType
    block = StructType().add("ids", ArrayType(LongType())).add("labels", ArrayType(label))
    kind = arrow_type(kept.select("label"))
    shelf = Shelf(spark)
    parts = "array<struct<places:binary,points:binary>>"
    shape = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in block)}, parts {parts}"
    blocks = shelf.store(kept.mapInArrow(_blocks(dimension, kind), shape))
    for _ in range(rounds if found else 0):
        codebooks = _moved(blocks, codebooks)
    if not found:
        coded = kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    else:
        coded = shelf.store(blocks.mapInArrow(_codes(codebooks, kind), f"vec_id long, label {label.simpleString()}, code string, error long"))
    # One row per label; `shared` is not a name of the other side.
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    totals = coded.groupBy(F.col("label").alias("shared")).agg(F.least(total, F.lit(Decimal(LARGEST_LONG))).cast("long").alias("label_error"))
    joined = sized_join(coded, totals, F.col("label").eqNullSafe(F.col("shared")), "left")
    return shelf.result(joined.drop("shared").withColumn("codebooks_sha256", F.lit(digest(codebooks))))


def arrow_type(column: DataFrame) -> pa.DataType:
    """Arrow's type of a frame's one column."""
    return column.limit(0).toArrow().schema.field(0).type


def oracle(rounds: int = ROUNDS) -> str:
    """The same as DuckDB SQL, by comparing every part with every entry."""
    nearest = """n{at} AS MATERIALIZED (
    SELECT row, part, min(d * 256 + entry) AS best FROM (
        SELECT row, part, entry, sum((x - c) * (x - c))::BIGINT AS d FROM v JOIN c{at} USING (part, place) GROUP BY row, part, entry)
    GROUP BY row, part)"""
    moved = """m{at} AS (
    SELECT part, (best & 255) AS entry, place, floor(sum(x) / count(*))::BIGINT AS c FROM n{before} JOIN v USING (row, part) GROUP BY ALL),
c{at} AS MATERIALIZED (SELECT part, entry, place, coalesce(m{at}.c, c{before}.c) AS c FROM c{before} LEFT JOIN m{at} USING (part, entry, place))"""
    steps = [nearest.format(at=0)]
    for at in range(1, rounds + 1):
        steps += [moved.format(at=at, before=at - 1), nearest.format(at=at)]
    return f"""
WITH e AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label, embedding FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (
    SELECT row, i // (n // {PARTS}) AS part, i % (n // {PARTS}) AS place, x FROM (
        SELECT row, len(embedding) AS n, unnest(range(len(embedding))) AS i, floor({SCALE} * unnest(embedding)::DOUBLE)::BIGINT AS x FROM e)),
c0 AS MATERIALIZED (SELECT part, row - 1 AS entry, place, x AS c FROM v WHERE row <= {ENTRIES}),
{", ".join(steps)},
coded AS (
    SELECT row, string_agg(printf('%02x', best & 255), '' ORDER BY part) AS code, sum(best >> 8)::BIGINT AS error FROM n{rounds} GROUP BY row)
SELECT vec_id, label, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
    (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, place)) FROM c{rounds}) AS codebooks_sha256
FROM e JOIN coded USING (row)
"""
