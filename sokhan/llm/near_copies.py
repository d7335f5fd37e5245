"""Near copies by similarity: SimHash BK-trees propose, the exact similarity decides.

Two texts are near copies if their sets of lower-cased word shingles have a
Jaccard similarity of at least ``similarity``; a class is what such links reach.
At 0.8, fingerprints of 64 bits differ in about ten bits, too many for blocks of
equal bits to find them, so the trees are sharded by minima instead:

1. Equal shingle sets are one node. A node's fingerprint counts each distinct
   shingle once, so that its distance follows the similarity, and its bands are
   ``BANDS`` values of ``ROWS`` minima each of the shingles under fixed mixings.
   At 0.8 two nodes share a band with probability 0.998; they are within
   ``RADIUS`` bits with probability 0.999, or 0.995 for texts of four or five
   shingles. Closer texts are missed less.
2. Each band's value is a shard with a BK-tree of its fingerprints. Links within
   the radius give groups of possible near copies, of thin rows only. A shard of
   more than ``SHARD_NODES`` fingerprints is one group as it is.
3. Each group's shingle sets meet once, in trees again, and fingerprints within
   the radius are compared exactly. Verified links give the classes.

A tree remembers which subtrees lie in one class as a whole and skips them for
members of that class, so a group of thousands of copies costs no pairs. A group
of more than ``TREE_NODES`` nodes or ``TREE_SHINGLES`` shingles is first rid of the
nodes that can't be similar to any other, since too many of their shingles occur in
no other node of the group; that counts shingles, not pairs. The rest is dealt to several
trees, ``ROUNDS`` times by other hashes; links inside these trees show which nodes
are of one class. Only nodes outside their group's largest class then query
all of the group, in trees of ``WIDER`` times the nodes and in pieces of as many
queries. No link is lost, and no row is sent for pairs within the largest class;
nodes of smaller classes that could still be similar to some other are what costs
rows by their number times that of trees.

Texts without words (nulls too) are one node; nodes are told apart by 64-bit
hashes of their sets. Null ids sort first, repeated rows count once, and other
columns are kept as they are. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sokhan.llm.common import by_batch, partitions, prepare, utf8
from sokhan.llm.simhash import BKTree, components, fingerprint, shingle_hashes, signed, tree_links

ROWS, BANDS, RADIUS = 4, 12, 20
#: Nodes of a shard's tree, nodes and shingles of a group's tree.
SHARD_NODES, TREE_NODES, TREE_SHINGLES = 512, 128, 1_000_000
#: Times that a large group is dealt to trees, and how much wider the trees are that its last queries meet.
ROUNDS, WIDER = 3, 6
#: Parts of a group where its rows meet its size.
SALTS = 16
#: Rows of groups of several up to which their keys, some 100 bytes each, are broadcast to the texts.
BROADCAST_ROWS = 300_000
#: Odd factors and masks that mix a shingle's hash, the same in every process.
_MIX = np.random.Generator(np.random.PCG64(42)).integers(0, 1 << 63, (2, ROWS * BANDS), np.uint64)
_FACTOR, _MASK = _MIX[0] << np.uint64(1) | np.uint64(1), _MIX[1] << np.uint64(1)


def shingle_set(text: bytes, size: int, seed: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    return np.unique(shingle_hashes(text, size, seed))


def bands(shingles: np.ndarray) -> list[int]:
    """BANDS signed values, each of ROWS minima; none for an empty set."""
    if not len(shingles):
        return []
    least = np.full(ROWS * BANDS, np.iinfo(np.uint64).max)
    for i in range(0, len(shingles), 2048):
        mixed = (shingles[i : i + 2048, None] ^ _MASK) * _FACTOR
        np.minimum(least, mixed.min(axis=0), out=least)
    return [signed(xxhash.xxh64_intdigest(row.tobytes())) for row in least.reshape(BANDS, ROWS)]


class ClassTree(BKTree):
    """A BK-tree over items' fingerprints that links items and knows their classes.

    ``same(a, b)`` decides on two items within the radius. It isn't asked where
    both are linked already, and subtrees of one class are skipped for its members.
    """

    def __init__(self, radius: int, same: Callable[[tuple, tuple], bool]):
        super().__init__()
        self.radius, self.same = radius, same
        self.items: dict[int, list[int]] = {}
        self.kept: list[tuple] = []
        self.parent: list[int] = []
        #: A node's subtree lies in the class of this item; None if in several.
        self.whole: dict[int, int | None] = {}

    def class_of(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    def links(self, item: tuple) -> Iterator[int]:
        """Items that connect this one (fingerprint first) to every class that it is linked to."""
        self.at = None
        fp, todo = item[0], [] if self.root is None else [self.root]
        while todo:
            node = todo.pop()
            whole = self.whole[node]
            if whole is not None and self.at is not None and self.class_of(whole) == self.class_of(self.at):
                continue
            d = (fp ^ node).bit_count()
            if d <= self.radius:
                for i in self.items[node]:
                    if (self.at is None or self.class_of(i) != self.class_of(self.at)) and self.same(self.kept[i], item):
                        if self.at is not None:
                            self.parent[self.class_of(i)] = self.class_of(self.at)
                        self.at = i
                        yield i
            for edge, child in self.children[node].items():
                if d - self.radius <= edge <= d + self.radius:
                    todo.append(child)

    def insert(self, item: tuple) -> None:
        """Add an item whose links have just been read, so it joins their class."""
        i, fp = len(self.kept), item[0]
        self.kept.append(item)
        self.parent.append(i if self.at is None else self.class_of(self.at))
        new = fp not in self.items
        self.add(fp)
        self.items.setdefault(fp, []).append(i)
        if new:
            self.whole[fp] = i
        node, mine = self.root, self.class_of(i)
        while True:
            whole = self.whole[node]
            if whole is not None and self.class_of(whole) != mine:
                self.whole[node] = None
            if node == fp:
                return
            node = self.children[node][(fp ^ node).bit_count()]


def class_links(members: list[tuple], queries: Iterator[tuple], radius: int, same: Callable[[tuple, tuple], bool]) -> Iterator[tuple[tuple, tuple]]:
    """Pairs of items that connect what one tree's members and further queries link."""
    tree = ClassTree(radius, same)
    for item in members:
        for i in tree.links(item):
            yield tree.kept[i], item
        tree.insert(item)
    for item in queries:
        for i in tree.links(item):
            yield tree.kept[i], item


def key(doc_id: Column, text_hash: Column) -> Column:
    """What rows are told apart by, as one column: a struct's nulls are equal in joins."""
    return F.struct(doc_id.cast("long").alias("id"), text_hash.alias("hash")).alias("_key")


def nodes_of(thin: DataFrame, shingle: int, seed: int) -> DataFrame:
    """doc_id, text_hash, node, fp, n_shingles and bands of rows (doc_id, text, text_hash)."""
    schema = "doc_id long, text_hash long, node long, fp long, n_shingles long, bands array<long>"
    out = pa.schema([(c, pa.int64()) for c in ("doc_id", "text_hash", "node", "fp", "n_shingles")] + [("bands", pa.list_(pa.int64()))])

    def run(batch: pa.RecordBatch) -> dict[str, list]:
        rows = []
        for text in utf8(batch.column("text")):
            s = shingle_set(text, shingle, seed)
            rows.append((signed(xxhash.xxh64_intdigest(s.tobytes())), fingerprint(s), len(s), bands(s)))
        return {"doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash")} | {c: [r[k] for r in rows] for k, c in enumerate(out.names[2:])}

    return by_batch(thin, run, schema, out)


def sized(rows: DataFrame, group: list[str], by: str, weight: str | None = None) -> DataFrame:
    """Rows of groups of several with the group's number of rows n and its sum of weights w.

    A large group's rows are dealt over tasks by a salt, each of which meets a copy of the group's one row of sizes.
    """
    sizes = rows.groupBy(*group).agg(F.count("*").alias("n"), (F.sum(weight) if weight else F.lit(0)).alias("w")).filter("n > 1")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(by, F.lit(2)), F.lit(SALTS)).cast("int"))
    return salted.join(sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [*group, "salt"]).drop("salt")


def candidate_groups(nodes: DataFrame, radius: int) -> DataFrame:
    """fp and group of the fingerprints that a chain of links within the radius, or of large shards, connects."""
    keyed = sized(nodes.select("fp", F.posexplode("bands").alias("pair", "value")).distinct(), ["pair", "value"], "fp").checkpoint()
    mask = (1 << 64) - 1

    def linker(members: list[tuple], queries: Iterator[tuple]) -> Iterator[tuple[int, int]]:
        plain = [(x & mask,) for (x,) in members]
        for (a,), (b,) in class_links(plain, ((x & mask,) for (x,) in queries), radius, lambda a, b: True):
            yield signed(a), signed(b)

    large = keyed.filter(F.col("n") > SHARD_NODES)
    hubs = large.groupBy("pair", "value").agg(F.min("fp").alias("v"))
    chained = large.join(hubs.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [large["pair"] == hubs["pair"], large["value"] == hubs["value"], F.pmod(F.xxhash64("fp"), F.lit(SALTS)) == F.col("at")]).select(F.col("fp").alias("u"), "v")
    near = tree_links(keyed.filter(F.col("n") <= SHARD_NODES).withColumn("query", F.lit(False)), ["pair", "value"], ["fp"], linker)
    return components(near.unionByName(chained)).select(F.col("node").alias("fp"), F.col("root").alias("group"))


def verified_links(thin: DataFrame, attach: Callable[[DataFrame], DataFrame], radius: int, similarity: float) -> DataFrame:
    """Links (u, v) of nodes in thin rows (group, node, fp, n, w), by exact similarity; attach adds their shingles."""
    mask = (1 << 64) - 1

    def same(a: tuple, b: tuple) -> bool:
        x, y = a[2], b[2]
        if min(len(x), len(y)) < similarity * max(len(x), len(y)) - 1:
            return False
        both = len(np.intersect1d(x, y, assume_unique=True))
        return both / (len(x) + len(y) - both) >= similarity

    def linker(members: list[tuple], queries: Iterator[tuple]) -> Iterator[tuple[int, int]]:
        def item(row: tuple) -> tuple:
            return row[0] & mask, row[1], np.frombuffer(row[2], np.uint64)

        for a, b in class_links([item(m) for m in members], map(item, queries), radius, same):
            yield a[1], b[1]

    def linked(rows: DataFrame) -> DataFrame:
        return tree_links(rows, ["group", "tree", "piece"], ["fp", "node", "shingles"], linker)

    def trees(nodes: int) -> Column:
        return F.ceil(F.greatest(F.col("n") / nodes, F.col("w") / (TREE_SHINGLES * nodes // TREE_NODES))).cast("int")

    def tree(seed: int, n: Column) -> Column:
        return F.pmod(F.xxhash64("node", F.lit(seed)), n).cast("int")

    alone = {"tree": F.lit(0), "piece": F.lit(0), "query": F.lit(False)}
    sets = attach(thin)
    if thin.filter(trees(TREE_NODES) > 1).isEmpty():
        return linked(sets.withColumns(alone))
    sets = sets.checkpoint()
    small = linked(sets.filter(trees(TREE_NODES) == 1).withColumns(alone))
    sets = possible(sets.filter(trees(TREE_NODES) > 1).drop("n", "w"), similarity)
    sets = sized(sets, ["group"], "node", "n_shingles").checkpoint()
    dealt = [linked(sets.withColumns(alone | {"tree": tree(k, trees(TREE_NODES))})) for k in range(ROUNDS)]
    made = reduce(DataFrame.unionByName, [small, *dealt]).checkpoint()
    # Nodes by class so far: those outside their group's largest class meet all of the group.
    ids = sets.select("group", "node").join(components(made), "node", "left").select("group", "node", F.coalesce("root", "node").alias("class"))
    counts = ids.groupBy("group", "class").agg(F.count("*").alias("k"))
    largest = counts.groupBy("group").agg(F.max(F.struct("k", "class")).alias("top"), F.sum("k").alias("all")).select("group", F.col("top.class").alias("most"), (F.col("all") - F.col("top.k")).alias("others")).filter("others > 0")
    apart = ids.join(largest, "group").select("node", (F.col("class") != F.col("most")).alias("other"), "others")
    wide = trees(WIDER * TREE_NODES)
    met = sets.join(apart, "node").withColumns({"trees": wide, "pieces": F.ceil(F.col("others") / (WIDER * TREE_NODES)).cast("int")}).checkpoint()
    names = ["group", "tree", "piece", "query", "fp", "node", "shingles"]
    members = met.withColumns({"tree": tree(0, F.col("trees")), "piece": F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)), "query": F.lit(False)})
    asked = met.filter("other").withColumns({"tree": F.explode(F.sequence(F.lit(0), F.col("trees") - 1)), "piece": tree(ROUNDS, F.col("pieces")), "query": F.lit(True)})
    return made.unionByName(linked(members.select(*names).unionByName(asked.select(*names))))


def possible(sets: DataFrame, similarity: float) -> DataFrame:
    """Rows (group, node, shingles, n_shingles) without those that are similar to no other of their group.

    A node shares at least ``similarity`` of its shingles with one that is similar to it,
    so as many occur in other nodes; shingles that occur in one node only are counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, node, shingles in zip(*(batch.column(c).to_pylist() for c in ("group", "node", "shingles")), strict=True):
                for at in range(0, len(shingles), 8 << 16):
                    s = np.frombuffer(shingles[at : at + (8 << 16)], np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), group)), pa.array(np.full(len(s), node)), pa.array(s)], ["group", "node", "s"])

    each = sets.select("group", "node", "shingles").mapInArrow(run, "group long, node long, s long")
    only = each.groupBy("group", "s").agg(F.count("*").alias("c"), F.min("node").alias("node")).filter("c = 1").groupBy("node").agg(F.count("*").alias("only"))
    shared = F.col("n_shingles") - F.coalesce("only", F.lit(0))
    return sets.join(only, "node", "left").filter(shared >= F.col("n_shingles") * F.lit(similarity) - 1e-9).drop("only")


def classes(df: DataFrame, shingle: int, similarity: float, radius: int, seed: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_hash and root (one value for each class) of every row."""
    prepare(df.sparkSession)
    text = F.col(text_col).cast("string")
    thin = df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"))
    prints = nodes_of(thin, shingle, seed).checkpoint()
    # One row stands for a node; ids and hashes of the rest are not needed to link.
    stands = F.min(F.struct("doc_id", "text_hash", "fp", "n_shingles", "bands")).alias("k")
    nodes = prints.groupBy("node").agg(stands).select("node", "k.*").checkpoint()
    grouped = nodes.drop("bands").join(candidate_groups(nodes, radius), "fp", "left").withColumn("group", F.coalesce("group", "fp"))
    names = {"group": "long", "node": "long", "fp": "long", "n_shingles": "long", "n": "long", "w": "long"}
    wanted = sized(grouped, ["group"], "node", "n_shingles").select(key(F.col("doc_id"), F.col("text_hash")), *(F.col(c).cast(t) for c, t in names.items())).checkpoint()
    out = pa.schema([(c, pa.int64()) for c in names] + [("shingles", pa.binary())])

    def run(batch: pa.RecordBatch) -> dict[str, list]:
        return {c: batch.column(c) for c in names} | {"shingles": [shingle_set(t, shingle, seed).tobytes() for t in utf8(batch.column("text"))]}

    def attach(rows: DataFrame) -> DataFrame:
        # Only texts of groups of several are read again; equal rows stand for the same node.
        right = F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows
        met = thin.select(key(F.col("doc_id"), F.col("text_hash")), "text").join(right, "_key").dropDuplicates(["_key"])
        return by_batch(met.select(*names, "text"), run, ", ".join(f"{c} {t}" for c, t in names.items()) + ", shingles binary", out)

    linked = components(verified_links(wanted, attach, radius, similarity))
    return prints.join(linked, "node", "left").select("doc_id", "text_hash", F.coalesce("root", "node").alias("root"))


def keep_one(df: DataFrame, shingle: int = 5, similarity: float = 0.8, radius: int = RADIUS, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of one row of each class: that of the smallest id (nulls first), then text hash."""
    named = classes(df, shingle, similarity, radius, seed, id_col, text_col)
    chosen = named.groupBy("root").agg(F.min(key(F.col("doc_id"), F.col("text_hash"))).alias("_key")).select("_key")
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), key(F.col(id_col), F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))))
    # The join and what drops repeated rows share one exchange.
    return rows.join(chosen, "_key", "left_semi").dropDuplicates(["_key"]).select("row.*")
