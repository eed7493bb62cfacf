"""Near-duplicates by MinHash signatures and a multi-index Hamming join.

A document is the set of its distinct 2-word shingles. Its signature has one b-bit MinHash value per slot. Slots are
split into chunks; two signatures that differ in fewer than CHUNKS * (ERRORS + 1) slots have, by the pigeonhole
principle, a chunk with at most ERRORS differences. So each chunk is indexed once per choice of ERRORS slots to leave
out, and every such pair meets under some key. At a similarity of 0.8 a pair misses all keys with probability 1e-7.

Keys can be hot. No bucket is paired with itself: first each node is compared with one other, of those that share most
keys with the rest the one it shares most keys with, and the links found are contracted to components. Members of one
component need no further comparison, so a group of copies costs its size, not its square. What still shares a key
across components is paired only if the sets may be similar: each has a bitmap that its shingles are folded into, and
every bit that two bitmaps differ in is a shingle that the sets do not share, which bounds their similarity from above.
Links are confirmed on whole shingle sets.
"""

from __future__ import annotations

import functools
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import Shelf, free_names, located, whole_text
from millrace.operators import numbered
from millrace.plans.sizing import sized_join

CHUNKS, SLOTS, ERRORS = 12, 5, 1
BITS = 16
# Intersection over union, in percent, from which two documents are linked.
SIMILAR = 80
# 64-bit words of a set's bitmap.
WORDS_OF_BITS = 16
REMEMBERED = 200_000
# Shingles that are hashed for all slots at a time.
BLOCK = 4096

_ROLL = np.random.default_rng(8)
FACTORS = _ROLL.integers(0, 1 << 63, CHUNKS * SLOTS, np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _ROLL.integers(0, 1 << 63, CHUNKS * SLOTS, np.uint64)
LEFT_IN = [keep for keep in combinations(range(SLOTS), SLOTS - ERRORS)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers whose bits all depend on each other."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Words(dict):
    """64-bit hash per word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


@functools.cache
def words() -> Words:
    return Words()


def shingles(text: str) -> np.ndarray:
    """The sorted set of 64-bit hashes of the text's shingles; one word alone is a shingle."""
    parts = text.encode(errors="replace").lower().split()
    h = np.fromiter(map(words().__getitem__, parts), np.uint64, len(parts))
    if len(h) > 1:
        h = mix(h[:-1]) + np.uint64(3) * h[1:]
    return np.unique(mix(h))


def signature(found: np.ndarray) -> np.ndarray:
    """BITS bits of the least hash in each slot."""
    least = np.full(CHUNKS * SLOTS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(found), BLOCK):
        block = found[start : start + BLOCK]
        least = np.minimum(least, (block * FACTORS[:, None] + OFFSETS[:, None]).min(axis=1))
    return (mix(least) >> np.uint64(64 - BITS)).astype("<u2")


def chunk_keys(slots: np.ndarray) -> np.ndarray:
    """Keys of signatures, a row each: chunk by chunk, with each choice of slots left out."""
    chunks = slots.astype(np.uint64).reshape(-1, CHUNKS, SLOTS)
    keys = np.empty((len(chunks), len(LEFT_IN), CHUNKS), np.uint64)
    for at, keep in enumerate(LEFT_IN):
        key = np.arange(CHUNKS, dtype=np.uint64) * np.uint64(len(LEFT_IN)) + np.uint64(at)
        for slot in keep:
            key = mix((key << np.uint64(BITS)) ^ (key >> np.uint64(64 - BITS)) ^ chunks[:, :, slot])
        keys[:, at] = key
    return keys.reshape(len(chunks), -1).view(np.int64)


def bitmap(found: np.ndarray) -> np.ndarray:
    """The set folded into WORDS_OF_BITS words."""
    bits = np.zeros(64 * WORDS_OF_BITS, np.uint8)
    bits[(found >> np.uint64(20)) % np.uint64(len(bits))] = 1
    return np.packbits(bits).view(np.int64)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two shingle sets are similar enough."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= SIMILAR * (len(a) + len(b) - common) and common > 0


def document_facts(docs: DataFrame, shelf: Shelf, text: str = "text") -> DataFrame:
    """doc_id, number of shingles, digest of the set and signature of each row, computed once."""

    @F.arrow_udf("struct<n:long,cls:binary,sig:array<short>,bits:array<long>>")
    def facts(texts: pa.Array) -> pa.Array:
        sets = [shingles(t.as_py()) for t in texts]
        columns = [
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
            pa.array([signature(s).view(np.int16) for s in sets], pa.list_(pa.int16())),
            pa.array([bitmap(s) for s in sets], pa.list_(pa.int64())),
        ]
        return pa.StructArray.from_arrays(columns, ["n", "cls", "sig", "bits"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), facts(whole_text(text)).alias("f"))
    return shelf.store(found.select("doc_id", "f.*"))


def buckets(classes: DataFrame, shelf: Shelf) -> DataFrame:
    """(key, pos, node, n, score): members of keys that several nodes share; the score says how much a node shares.

    `pos` tells the chunk of the key and the slots left out; it is the same for all members of a key.
    """

    @F.arrow_udf("array<long>")
    def keys(signatures: pa.Array) -> pa.Array:
        found = chunk_keys(signatures.flatten().to_numpy(zero_copy_only=False).astype(np.int16).view(np.uint16))
        ends = pa.array(np.arange(len(found) + 1) * (CHUNKS * len(LEFT_IN)), pa.int32())
        return pa.ListArray.from_arrays(ends, pa.array(found.ravel()))

    width = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = classes.repartition(width).select("node", "n", F.posexplode(keys("sig")).alias("pos", "key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    members = shelf.store(keyed.join(shared, "key"))
    scores = members.groupBy("node").agg(F.sum("members").alias("score"))
    return shelf.store(members.drop("members").join(scores, "node"))


def confirmed(pairs: DataFrame, docs: DataFrame, text: str, shelf: Shelf) -> DataFrame:
    """The pairs (a, b) of nodes that are linked, by their whole sets."""

    @F.arrow_udf("binary")
    def sets(texts: pa.Array) -> pa.Array:
        return pa.array([shingles(t.as_py()).tobytes() for t in texts], pa.binary())

    @F.arrow_udf("boolean")
    def similar(left: pa.Array, right: pa.Array) -> pa.Array:
        both = zip(left.to_pylist(), right.to_pylist(), strict=True)
        return pa.array([linked(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) for a, b in both], pa.bool_())

    near = shelf.store(pairs)
    ids = near.select(F.col("a").alias("doc_id")).union(near.select("b")).distinct()
    needed = sized_join(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(text).alias("_t")), ids, ["doc_id"], "left_semi")
    found = needed.select("doc_id", sets("_t").alias("s"))
    left, right = (found.select(F.col("doc_id").alias(x), F.col("s").alias(f"s_{x}")) for x in "ab")
    rows = near.join(right, "b").join(left, "a").filter(similar("s_a", "s_b"))
    return shelf.store(rows.select("a", "b").distinct())


def components(edges: DataFrame, shelf: Shelf) -> DataFrame:
    """(node, component) for the nodes of `edges` (a, b); the component is the least node reachable.

    Alternating stars: each node's larger neighbours, then its smaller ones, are hung on its least neighbour, until
    nothing changes. Least neighbours are partial aggregates, so a node with very many edges is not gathered.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct()
    edges = shelf.store(edges)
    before = None
    while True:
        both = edges.union(edges.select("u", "v"))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("x"), F.least("v", "m").alias("m"))
        # Large star: neighbours greater than the node.
        large = edges.select(F.col("u").alias("x"), "v").join(least, "x").select("v", F.col("m").alias("u"))
        large = large.filter("v <> u").distinct()
        # Small star: neighbours smaller than the node, and the node itself.
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).union(least.select("v", F.col("m").alias("u")))
        edges = shelf.store(small.filter("v <> u").distinct())
        after = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "u")), F.count_distinct("u")).first()
        if after == before or after[0] == 0:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("component"))
        before = after


def near_groups(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of `docs`.

    Null text counts as empty. A text without words is linked with nothing, and neither is a row with a null doc_id,
    whose component_id is null and which is kept. Rows that repeat a doc_id with the same text get the same answer.
    Other columns are not read.
    """
    shelf = Shelf(docs.sparkSession)
    facts = document_facts(docs, shelf, text)
    named = facts.filter("n > 0 and doc_id is not null")
    # Equal sets are one node from here on, named by the least doc_id.
    classes = named.groupBy("cls").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("bits").alias("bits"))
    classes = shelf.store(classes)
    whole = components(_links(buckets(classes, shelf), classes, docs, text, shelf), shelf)
    named = classes.select("cls", "node").join(whole, "node", "left")
    named = named.select("cls", F.coalesce("component", "node").alias("component_id"))
    found = facts.withColumn("_known", (F.col("n") > 0) & F.col("doc_id").isNotNull())
    found = found.join(named, ["cls"], "left")
    component = F.when(F.col("_known"), F.col("component_id")).otherwise(F.col("doc_id"))
    found = found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return shelf.result(found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def _links(members: DataFrame, classes: DataFrame, docs: DataFrame, text: str, shelf: Shelf) -> DataFrame:
    """Links that have the components of all links."""
    best = members.groupBy("key").agg(F.max(F.struct("score", "node", "n")).alias("p"))
    best = best.select("key", F.col("p.node").alias("other"), F.col("p.n").alias("n2"))
    sizes = (F.col("n") * 100 >= F.col("n2") * SIMILAR) & (F.col("n2") * 100 >= F.col("n") * SIMILAR)
    tried = members.join(best, "key").filter(sizes & (F.col("node") != F.col("other")))
    tried = tried.groupBy("node", "other").agg(F.count("*").alias("k")).groupBy("node")
    tried = tried.agg(F.max(F.struct("k", "other")).alias("p")).select("node", F.col("p.other").alias("other"))
    links = confirmed(_ordered(tried), docs, text, shelf)
    # What still shares a key across components.
    at = members.select("key", "pos", "node", "n").join(components(links, shelf), "node", "left")
    at = shelf.store(at.select("key", "pos", "node", "n", F.coalesce("component", "node").alias("c")))
    mixed = at.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("key")
    bits = [F.get("bits", F.lit(i)).alias(f"b{i}") for i in range(WORDS_OF_BITS)]
    at = at.join(mixed, "key", "left_semi").join(classes.select("node", "sig", *bits), "node")
    other = at.select("key", *[F.col(c).alias(f"{c}_2") for c in at.columns if c not in ("key", "pos")])
    differ = sum((F.bit_count(F.col(f"b{i}").bitwiseXOR(F.col(f"b{i}_2"))) for i in range(WORDS_OF_BITS)), F.lit(0))
    # With d shingles not shared, the similarity is at most (n + n2 - d) / (n + n2 + d).
    similar = (F.col("n") + F.col("n_2") - differ) * 100 >= (F.col("n") + F.col("n_2") + differ) * SIMILAR
    across = at.join(other, (at["key"] == other["key"]) & (F.col("c") < F.col("c_2")) & similar & _first_key())
    return links.union(confirmed(_ordered(across.select("node", F.col("node_2").alias("other"))), docs, text, shelf))


def _first_key() -> Column:
    """Whether the key, at `pos`, is the first of those that the signatures `sig` and `sig_2` share.

    It is if no chunk before has few enough errors, and of the choices of slots in its own chunk it is the first: of
    a chunk without errors all are shared, of one with an error only one.
    """

    def errors(chunk: Column) -> Column:
        slots = [chunk.cast("int") * SLOTS + i for i in range(SLOTS)]
        return sum(((F.get("sig", i) != F.get("sig_2", i)).cast("int") for i in slots), F.lit(0))

    chunk, choice = F.col("pos") % CHUNKS, F.floor(F.col("pos") / CHUNKS)
    earlier = F.exists(F.sequence(F.lit(0), F.lit(CHUNKS - 1)), lambda at: (at < chunk) & (errors(at) <= ERRORS))
    return ~earlier & ((choice == 0) | (errors(chunk) > 0))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def near_dedup(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, one document of each group, with the columns they have.

    Rows that repeat an id are documents of their own: the first of them, by place, has the id, and the others get
    numbers above all ids. Of a group the smallest stays. Rows without an id, words or text stay.
    """
    placed, names = located(docs.withColumn("doc_id", F.col("doc_id").cast("long")))
    (key,) = free_names(placed, "_key")
    ids = placed.filter("doc_id is not null").groupBy("doc_id")
    ids = ids.agg(F.count("*").alias("n"), F.min(F.struct(*names)).alias("first"))
    top, most = ids.agg(F.max("doc_id"), F.max("n")).first()
    keyed = placed.withColumn(key, F.col("doc_id"))
    if (most or 0) > 1:
        again = sized_join(placed.select("doc_id", *names), ids.filter("n > 1"), ["doc_id"], "inner")
        again = again.filter(F.struct(*names) != F.col("first")).select(*names)
        fresh = numbered(again, names, key).withColumn(key, F.col(key) + F.lit(max(top, 0)))
        keyed = sized_join(placed, fresh, names, "left").withColumn(key, F.coalesce(key, "doc_id"))
    gone = near_groups(keyed.select(F.col(key).alias("doc_id"), text), text).filter(~F.col("kept"))
    gone = gone.select(F.col("doc_id").alias(key))
    return sized_join(keyed, gone, [key], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
