"""Sharding by a hierarchical weighted hash tree.

Shards hang in racks and racks in regions; a node weighs what the shards below it weigh. A key descends from the root:
at each node every child draws an exponential waiting time from a hash of (child, key) divided by its weight, and the
shortest wins, so a child is chosen in proportion to its weight. A draw depends on the child and the key alone. A child
whose weight rises only gains keys and one whose weight falls only loses them, siblings exchange none among themselves,
and a subtree in which no weight changes keeps the order of its own draws: rows move into, out of or within subtrees
whose weights change, and nowhere else.

A shard that joins a rack makes its rack and region heavier, and some of the keys they gain descend to its neighbours.
Where only the new shard may gain, it joins at the root (`joined`), as a subtree of its own.
"""

from __future__ import annotations

import json
import math
from collections import defaultdict
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import CRC_STEPS, crc32_sql, free_names, ready, whole_text
from millrace.operators import numbered
from millrace.session import materialise
from millrace.sinks import write_partitioned

SEED = 11
# Bytes that a row takes besides its text.
ROW_BYTES = 16
LEVELS = ("region", "rack", "shard")
RACK_SHARDS, REGION_RACKS = 5, 4


class Shard(NamedTuple):
    """A leaf of the tree. `region` and `rack` are names without a slash; a weight of 0 takes no rows."""

    shard: int
    region: str
    rack: str
    weight: float = 1.0


class Tree:
    """Shards by region and rack. Raises for repeated shards, names with a slash, and weights that are no weights."""

    def __init__(self, shards: list[Shard]) -> None:
        self.shards = sorted(shards)
        if len({s.shard for s in self.shards}) < len(self.shards):
            raise ValueError("a shard is in the tree twice")
        if any("/" in s.region + s.rack for s in self.shards):
            raise ValueError("a region or rack has a slash in its name")
        if not all(0 <= s.weight < math.inf for s in self.shards) or not any(s.weight for s in self.shards):
            raise ValueError("weights are finite and not negative, and one at least is above 0")

    def children(self) -> dict[str, list[tuple[str, float]]]:
        """Path of each inner node to the paths and weights of its children; the root's path is empty."""
        below: dict[str, dict[str, list[float]]] = defaultdict(lambda: defaultdict(list))
        for s in self.shards:
            path = ""
            for name in (s.region, s.rack, str(s.shard)):
                child = f"{path}/{name}"
                if s.weight:
                    below[path][child].append(s.weight)
                path = child
        return {path: sorted((child, math.fsum(w)) for child, w in nodes.items()) for path, nodes in below.items()}

    def joined(self, shard: int, weight: float = 1.0) -> Tree:
        """With one more shard at the root: rows move into that shard and nowhere else."""
        return Tree([*self.shards, Shard(shard, f"joined-{shard}", "0", weight)])

    def reweighted(self, weights: dict[int, float]) -> Tree:
        """With other weights of some shards."""
        return Tree([s._replace(weight=weights.get(s.shard, s.weight)) for s in self.shards])


def layout(n: int) -> Tree:
    """Shards 0 to n - 1 of equal weight, five to a rack and four racks to a region."""
    racks = [(s, s // RACK_SHARDS) for s in range(n)]
    return Tree([Shard(s, str(r // REGION_RACKS), str(r)) for s, r in racks])


def _wait(child: Column, weight: Column, key: Column) -> Column:
    """Waiting time of a child: exponential, at a rate that is its weight."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{SEED}|"), child, F.lit("|"), key).cast("binary")), 1, 13)
    return -F.ln((F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))) / weight


def path_of(key: str, tree: Tree) -> Column:
    """Where the rows of a key go, as `/region/rack/shard`. Null keys go where empty ones do."""
    nodes = {p: [{"node": child, "weight": w} for child, w in below] for p, below in tree.children().items()}
    # A constant, so it is parsed once per task; a row looks at the children of three nodes.
    known = F.from_json(F.lit(json.dumps(nodes)), "map<string,array<struct<node:string,weight:double>>>")
    text, path = F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("")
    for _ in LEVELS:
        waits = F.transform(F.element_at(known, path), lambda c: F.struct(_wait(c["node"], c["weight"], text), c["node"].alias("node")))
        path = F.array_min(waits)["node"]
    return path


def place(docs: DataFrame, tree: Tree, key: str = "doc_id", name: str = "shard") -> DataFrame:
    """`docs` with the shard of each row, from its key alone. No row moves for it.

    A column called `name` is replaced, others stay. Rows that repeat a key go to the same shard, null keys to that of
    the empty text.
    """
    return docs.withColumn(name, F.element_at(F.split(path_of(key, tree), "/"), -1).cast("int"))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `size`, the bytes of the text in UTF-8 (null: none) and 16, and `text_crc32`, its CRC-32."""
    octets = whole_text(text).cast("binary")
    return docs.withColumns({"size": (F.octet_length(octets) + ROW_BYTES).cast("long"), "text_crc32": F.crc32(octets)})


def slotted(placed: DataFrame, key: str = "doc_id") -> DataFrame:
    """Placed rows with `slot`, their place in the shard from 0 on without gaps, in an order by a hash of the key.

    Takes what `place` and `measured` return. Rows are numbered by ranges of (shard, hash, key), so a shard is dealt over
    many tasks and so are rows that repeat a key; only rows that agree in key, size and CRC-32 too may swap places.
    """
    lot, salt, start, at = free_names(placed, "_lot", "_salt", "_start", "_at")
    marked = placed.withColumn(lot, F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")))
    marked = marked.withColumn(salt, F.monotonically_increasing_id())
    order = ["shard", lot, F.col(key).asc_nulls_first(), "size", "text_crc32", salt]
    rows = numbered(marked, order, at)
    # One row per shard of the tree.
    starts = rows.groupBy("shard").agg(F.min(at).alias(start))
    found = rows.join(F.broadcast(starts), "shard").withColumn("slot", F.col(at) - F.col(start))
    return found.drop(lot, salt, start, at)


def shard_rows(docs: DataFrame, tree: Tree, grown: Tree, keep_text: bool = True) -> DataFrame:
    """`docs` with `size`, `text_crc32`, `law`, `shard`, `slot`, and `grown_shard`, the shard in the tree `grown`.

    The law is `key`. Columns of the new names are replaced, others stay; empty tables give none.
    """
    ready(docs.sparkSession)
    rows = measured(docs) if keep_text else measured(docs).drop("text")
    rows = place(place(rows, tree), grown, name="grown_shard")
    # Range bounds are sampled, which would hash every text and key a second time.
    return slotted(materialise(rows.withColumn("law", F.lit("key"))))


def write_shards(docs: DataFrame, tree: Tree, path: str) -> None:
    """Documents as Parquet, a folder per region, rack and shard under `path`.

    Shards that `docs` has rows of are written anew and others stay as they are, so a changed subtree can be written by
    itself. Columns called region, rack or shard are replaced.
    """
    parts = F.split(path_of("doc_id", tree), "/")
    level = {name: F.element_at(parts, at + 2) for at, name in enumerate(LEVELS)}
    write_partitioned(docs.withColumns({**level, "shard": level["shard"].cast("int")}), path, list(LEVELS))


def oracle(tree: Tree, grown: Tree) -> str:
    """The same as DuckDB SQL."""
    values = ", ".join(
        f"({t}, '{path}', '{child}', {w!r}::DOUBLE)"
        for t, each in enumerate((tree, grown))
        for path, below in each.children().items()
        for child, w in below
    )
    wait = f"""-ln((('0x' || substr(md5('{SEED}|' || node || '|' || key), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / weight"""
    step = """{name} AS (
    SELECT tree, row, key, arg_min(node, {wait}) AS path FROM {before} JOIN nodes USING (tree, path) GROUP BY ALL)"""
    steps = ",\n".join(step.format(name=f"l{i + 1}", before=f"l{i}", wait=wait) for i in range(len(LEVELS)))
    return f"""
WITH RECURSIVE {CRC_STEPS},
nodes(tree, path, node, weight) AS (VALUES {values}),
d AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce(doc_id::VARCHAR, '') AS key, octet_length(encode(coalesce(text, ''))) + {ROW_BYTES} AS size,
        {crc32_sql("coalesce(text, '')")} AS text_crc32
    FROM documents, crc_steps),
l0 AS (SELECT tree, row, key, '' AS path FROM d, (VALUES (0), (1)) t(tree)),
{steps},
s AS (
    SELECT row, max(split_part(path, '/', 4)::INT) FILTER (tree = 0) AS shard, max(split_part(path, '/', 4)::INT) FILTER (tree = 1) AS grown_shard
    FROM l3 GROUP BY row)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY md5(key), doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard
FROM d JOIN s USING (row)
"""
