"""SimHash near-duplicates, linked through BK-trees.

A document's fingerprint has a bit set if over half of its shingles' XXH64 have
it. Distinct fingerprints at a Hamming distance of at most ``radius`` are linked;
a class is what links reach, named by its smallest document id.

Trees. A BK-tree keys a node's children by their distance to it, and a query
follows only edges within the radius of its own distance. One tree over all
fingerprints could be neither held nor broadcast at scale, and a broadcast's
size would follow the data, so trees are sharded: the bits are cut into
``radius + 2`` blocks, and two fingerprints within the radius agree in at least
two of them, so a shard is a pair of blocks with their values. Shards meet their
queries by one exchange in place of a broadcast. A shard of more than
``TREE_NODES`` fingerprints is dealt once more by its other bits: cut into
``FINER * radius`` blocks, of which all but ``radius`` agree, each choice of
these with its values is a smaller shard. At radius 2 that makes 28 rows of a
fingerprint and at most 256 fingerprints in a tree, however large the first shard
was, so rows grow linearly with it. A tree hands on a spanning set of links, at
most one for each member, not all pairs.

Equal fingerprints are one node, so exact copies cost nothing here. A text with
no words has fingerprint zero and is linked like any other; null texts have no
words. Rows with a null id belong to classes but never name one (a class of them
alone is named null). Repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, repeat
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sokhan.llm.common import LOWER, by_batch, id_and_text, partitions, prepare, table, utf8

TREE_NODES = 4096
#: Blocks for each differing bit where a large shard is dealt again; choices of them at most.
FINER, CHOICES = 4, 300
#: From a tree's members and its queries to the links that connect them.
Linker = Callable[[list[tuple], Iterator[tuple]], Iterator[tuple[int, int]]]


def shingle_hashes(text: bytes, size: int, seed: int) -> np.ndarray:
    """XXH64 of every shingle of lower-cased words; a shorter text is one shingle."""
    words = text.translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - size + 1)
    shingles = zip(*(words[i : i + n] for i in range(min(size, len(words)))), strict=True)
    return np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, shingles), repeat(seed)), np.uint64, n)


def fingerprint(hashes: np.ndarray) -> int:
    """As a signed 64-bit number."""
    if not len(hashes):
        return 0
    bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(df: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (long) of every row."""

    def run(batch: pa.RecordBatch) -> dict[str, list]:
        return {"doc_id": batch.column("doc_id"), "fp": [fingerprint(shingle_hashes(t, shingle, seed)) for t in utf8(batch.column("text"))]}

    return by_batch(id_and_text(df, id_col, text_col), run, "doc_id long, fp long", pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())]))


class BKTree:
    """Nodes' children are keyed by their Hamming distance to the node."""

    def __init__(self):
        self.root, self.children = None, {}

    def add(self, x: int) -> None:
        if self.root is None:
            self.root = x
            self.children[x] = {}
            return
        node = self.root
        while d := (x ^ node).bit_count():
            if d not in self.children[node]:
                self.children[node][d] = x
                self.children[x] = {}
                return
            node = self.children[node][d]

    def near(self, x: int, radius: int) -> Iterator[int]:
        """Nodes within the radius; only edges within radius of the node's distance are followed."""
        todo = [] if self.root is None else [self.root]
        while todo:
            node = todo.pop()
            d = (x ^ node).bit_count()
            if d <= radius:
                yield node
            for edge, child in self.children[node].items():
                if d - radius <= edge <= d + radius:
                    todo.append(child)


def shard_links(members: list[int], queries: Iterator[int], radius: int) -> Iterator[tuple[int, int]]:
    """Links that connect what one tree's members and further queries link."""
    tree = BKTree()
    for x in members:
        tree.add(x)
    parent = {x: x for x in members}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for x in members:
        for y in tree.near(x, radius):
            a, b = root(x), root(y)
            if a != b:
                parent[a] = b
                yield x, y
    for x in queries:
        at = None
        for y in tree.near(x, radius):
            if at is None:
                at = root(y)
                yield x, y
            elif (a := root(y)) != (b := root(at)):
                parent[a] = b
                yield x, y


def blocks(bits: list[int], n: int) -> list[int]:
    """Masks of n blocks of some bits, as even as can be; none is empty."""
    cuts = [len(bits) * i // n for i in range(n + 1)]
    return [sum(1 << k for k in bits[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def shard_masks(radius: int) -> tuple[list[int], list[list[int]]]:
    """Masks of the shards' bits: of every pair of blocks, and for each of these the finer ones."""
    pairs = [a | b for a, b in combinations(blocks(list(range(64)), radius + 2), 2)]
    n = next((k for k in range(FINER * radius, radius, -1) if comb(k, radius) <= CHOICES), radius + 1)
    finer = []
    for mask in pairs:
        rest = [k for k in range(64) if not mask >> k & 1]
        few = blocks(rest, min(n, len(rest))) if rest else []
        finer.append([mask | sum(c) for c in combinations(few, max(0, len(few) - radius))])
    return [signed(m) for m in pairs], [[signed(m) for m in ms] for ms in finer]


def keys(fp: Column, masks: Column) -> Column:
    """Structs of a mask's number and the bits under it."""
    return F.transform(masks, lambda m, k: F.struct(k.alias("mask"), fp.bitwiseAND(m).alias("bits")))


def longs(values: list[int]) -> Column:
    return F.array(*(F.lit(v).cast("long") for v in values)) if values else F.array().cast("array<bigint>")


def links(nodes: DataFrame, radius: int) -> DataFrame:
    """Links (u, v) that connect the distinct fingerprints (fp) as all links within the radius do."""
    pairs, finer = shard_masks(radius)
    none = F.lit(-1)
    keyed = nodes.select("fp", F.inline(keys(F.col("fp"), longs(pairs)))).withColumnsRenamed({"mask": "pair", "bits": "value"})
    sizes = keyed.groupBy("pair", "value").agg(F.count("*").alias("n")).filter("n > 1")
    # Shards of one member drop out.
    met = keyed.join(sizes, ["pair", "value"])
    smaller = F.when(F.col("n") > TREE_NODES, keys(F.col("fp"), F.get(F.array(*map(longs, finer)), F.col("pair")))).otherwise(F.array(F.struct(none.alias("mask"), F.lit(0).cast("long").alias("bits"))))
    rows = met.select("pair", "value", "fp", F.inline(smaller)).withColumn("query", F.lit(False))
    unsigned = (1 << 64) - 1

    def linker(members: list[tuple], queries: Iterator[tuple]) -> Iterator[tuple[int, int]]:
        for a, b in shard_links([x & unsigned for (x,) in members], (x & unsigned for (x,) in queries), radius):
            yield signed(a), signed(b)

    return tree_links(rows, ["pair", "value", "mask", "bits"], ["fp"], linker)


def tree_links(rows: DataFrame, order: list[str], item: list[str], linker: Linker) -> DataFrame:
    """Links (u, v) that linker gives for the rows of each tree (order): members' items, then those of its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple[int, int]] = []

        def groups():
            for batch in batches:
                keys = zip(*(batch.column(c).to_pylist() for c in order), strict=True)
                items = zip(*(batch.column(c).to_pylist() for c in item), strict=True)
                yield from zip(keys, batch.column("query").to_pylist(), items, strict=True)

        rows_of = groups()
        ahead = next(rows_of, None)
        while ahead is not None:
            key, members = ahead[0], []
            while ahead is not None and ahead[0] == key and not ahead[1]:
                members.append(ahead[2])
                ahead = next(rows_of, None)

            def queries(key=key):
                nonlocal ahead
                while ahead is not None and ahead[0] == key:
                    x = ahead[2]
                    ahead = next(rows_of, None)
                    yield x

            for pair in linker(members, queries()):
                made.append(pair)
                if len(made) >= 10_000:
                    yield batch_of(made)
                    made = []
        yield batch_of(made)

    def batch_of(made: list[tuple[int, int]]) -> pa.RecordBatch:
        pairs = np.array(made, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])

    n = partitions(rows.sparkSession)
    return rows.repartition(n, *order).sortWithinPartitions(*order, "query").select(*order, "query", *item).mapInArrow(run, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): each linked node and the smallest node that it reaches.

    Alternates large-star and small-star steps until nothing changes, O(log n)
    rounds as a rule; each round is checkpointed, so a lost executor costs that
    round at most. Hubs are pre-aggregated by their least neighbour.
    """
    prepare(edges.sparkSession)
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct().checkpoint()
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        e = small.filter("u != v").distinct().checkpoint()
        now = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def classes(prints: DataFrame, radius: int) -> DataFrame:
    """fp and component_id of every distinct fingerprint of (doc_id, fp)."""
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    reached = components(links(nodes.select("fp"), radius))
    roots = nodes.join(reached.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root")).checkpoint()
    named = roots.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return roots.join(named, "root").select("fp", "component_id")


def near_duplicates(df: DataFrame, shingle: int = 3, radius: int = 2, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp and component_id of every row."""
    prepare(df.sparkSession)
    prints = fingerprints(df, shingle, seed, id_col, text_col).checkpoint()
    return prints.join(classes(prints, radius), "fp").select("doc_id", "fp", "component_id")


def op10_simhash_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of every document."""
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
