"""Sharding by histogram sort.

Documents are ordered by (hash of the text, hash of the id, id) and cut into
shards of near equal bytes. The cuts are found without sorting: candidate keys
are laid over the key range, one distributed pass counts exactly the bytes and
rows below each of them, and the probes close in on each cut until the count is
within tolerance of its target. Then the rows are exchanged once, each to its
place, and numbered there from the counts already known.

The law is ``bytes``: a shard's bytes differ from the mean by at most twice the
tolerance. Equal texts are neighbours in the order; a cut that can fall between
two texts does, so a group of copies stays in one shard unless it lies across a
cut that no other key within tolerance can take. Such a group is cut by the
hash of the id.

Null texts have size 16 like empty ones; null ids hash like a value of their
own. Rows that agree in text and id are neighbours and get neighbouring slots.
An empty table gives no rows. Columns named like an added one (size, shard, slot) are
replaced; all others pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sokhan.llm.common import packed, partitions, prepare, table, unpacked

SHARDS, PROBES, TOLERANCE, OVERHEAD = 40, 64, 0.002, 16
#: Probes of one round, over all open cuts; each gets at least LEAST.
ASKED, LEAST = 1 << 18, 4
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def sizes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD


def below(keys: DataFrame, p1: np.ndarray, p2: np.ndarray) -> np.ndarray:
    """Exact bytes and rows (two columns) below each of the ascending probes over keys (k1, k2, size).

    A task counts its rows between probes; what it hands on is at most a row for
    each probe, summed again over tasks.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, len(p1) + 1), np.int64)
        for batch in batches:
            at = place(*(batch.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2")), p1, p2)
            for i, w in enumerate((batch.column("size").to_numpy(zero_copy_only=False), np.ones(len(at), np.int64))):
                np.add.at(total[i], at, w)
        used = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int64)), pa.array(total[0][used]), pa.array(total[1][used])], ["at", "bytes", "n"])

    found = keys.select("k1", "k2", "size").mapInArrow(count, "at long, bytes long, n long").groupBy("at").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).toArrow()
    total = np.zeros((len(p1) + 1, 2), np.int64)
    total[found.column("at").to_numpy()] = np.column_stack([found.column(c).to_numpy() for c in ("bytes", "n")])
    return np.cumsum(total, axis=0)[:-1]


def place(k1: np.ndarray, k2: np.ndarray, p1: np.ndarray, p2: np.ndarray) -> np.ndarray:
    """How many of the ascending probes are at or below each key."""
    low, high = np.searchsorted(p1, k1, "left"), np.searchsorted(p1, k1, "right")
    tied = np.flatnonzero(low < high)
    for v in np.unique(low[tied]) if len(tied) else ():
        rows = tied[low[tied] == v]
        low[rows] += np.searchsorted(p2[v : high[rows[0]]], k2[rows], "right")
    return low


def between(low: np.ndarray, high: np.ndarray, n: int) -> np.ndarray:
    """For each interval a row of n numbers from above low up to high, evenly laid."""
    gap = high.astype(np.uint64) - low.astype(np.uint64)  # wraps as wanted
    step, rest = gap // np.uint64(n + 1), gap % np.uint64(n + 1)
    i = np.arange(1, n + 1, dtype=np.uint64)
    off = step[:, None] * i + rest[:, None] * i // np.uint64(n + 1)
    off = np.minimum(np.maximum(off, np.uint64(1)), gap[:, None])
    return (low.astype(np.uint64)[:, None] + off).view(np.int64)


def spread(low: np.ndarray, high: np.ndarray, n: int) -> np.ndarray:
    """Ascending distinct keys (k1, k2) between those of each row of low and of high: by k1 as long as that differs, then by k2."""
    gap = high[:, 0].astype(np.uint64) - low[:, 0].astype(np.uint64)
    wide, step, same = gap > 1, gap == 1, gap == 0
    texts = between(low[wide, 0], high[wide, 0], n)
    ids = between(low[step, 1], np.full(step.sum(), HIGH), n)
    own = between(low[same, 1], high[same, 1], n)
    first = lambda a, x: np.broadcast_to(a[:, None], x.shape)
    made = [(texts, np.full_like(texts, LOW)), (first(low[step, 0], ids), ids), (high[step, :1], np.full((step.sum(), 1), LOW)), (first(low[same, 0], own), own)]
    out = np.concatenate([np.column_stack((a.ravel(), b.ravel())) for a, b in made])
    owner = np.concatenate([np.repeat(np.flatnonzero(m), k) for m, k in ((wide, n), (step, n), (step, 1), (same, n))])
    after = (out[:, 0] > low[owner, 0]) | (out[:, 0] == low[owner, 0]) & (out[:, 1] > low[owner, 1])
    before = (out[:, 0] < high[owner, 0]) | (out[:, 0] == high[owner, 0]) & (out[:, 1] < high[owner, 1])
    return np.unique(out[after & before], axis=0)


def nearest(weights: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """For each target the place of the nearest of the ascending weights."""
    at = np.clip(np.searchsorted(weights, targets), 1, max(1, len(weights) - 1))
    right = np.minimum(at, len(weights) - 1)
    return np.where(np.abs(weights[at - 1] - targets) <= np.abs(weights[right] - targets), at - 1, right)


def splitters(keys: DataFrame, n: int, tolerance: float = TOLERANCE, probes: int = PROBES) -> tuple[np.ndarray, np.ndarray]:
    """n - 1 cuts as keys and as (bytes, rows) below them, each within tolerance of its share of a part.

    A round is one pass over the thin keys; probes of a round shrink each open
    interval about ``probes`` times. Cuts between texts are taken if there is one.
    """
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    targets = total[0] * np.arange(1, n) / n
    slack = tolerance * total[0] / n
    known, under = np.array([[LOW, LOW], [HIGH, HIGH]]), np.array([[0, 0], list(total)], np.int64)
    while True:
        weights = under[:, 0]
        far = targets[np.abs(weights[nearest(weights, targets)] - targets) > slack]
        at = np.unique(np.searchsorted(weights, far))
        # Fewer than two rows between, or no key between: the nearer end is the best cut there is.
        at = at[under[at, 1] - under[at - 1, 1] > 1]
        asked = spread(known[at - 1], known[at], max(LEAST, min(probes, ASKED // max(1, len(at)))))
        if not len(asked):
            break
        known, under = np.concatenate((known, asked)), np.concatenate((under, below(keys, asked[:, 0].copy(), asked[:, 1].copy())))
        order = np.lexsort((known[:, 1], known[:, 0]))
        known, under = known[order], under[order]
    weights, whole = under[:, 0], np.flatnonzero(known[:, 1] == LOW)
    texts = whole[nearest(weights[whole], targets)]
    best = np.where(np.abs(weights[texts] - targets) <= slack, texts, nearest(weights, targets))
    best = np.maximum.accumulate(best)
    return known[best], under[best]


def shard_documents(df: DataFrame, shards: int = SHARDS, text_col: str = "text", id_col: str = "doc_id", tolerance: float = TOLERANCE) -> DataFrame:
    """All columns and size, shard, slot (from 0 without gaps in a shard's order).

    Each shard is cut further into parts, so that no task sorts more than about
    one of the session's shuffle partitions.
    """
    spark = df.sparkSession
    prepare(spark)
    text = F.col(text_col).cast("string")
    columns = {"k1": F.xxhash64(text, F.lit(1)), "k2": F.xxhash64(F.col(id_col), F.lit(2)), "size": sizes(text)}
    thin = df.select(*(v.alias(c) for c, v in columns.items())).checkpoint()
    per = max(1, -(-partitions(spark) // shards))
    cuts, under = splitters(thin, shards * per, tolerance)
    p1, p2 = cuts[:, 0].copy(), cuts[:, 1].copy()
    # Rows below a part, less those below its shard: where the part's slots begin.
    rows_below = np.concatenate(([0], under[:, 1]))
    first = rows_below - np.repeat(rows_below[::per], per)

    @F.arrow_udf("int")
    def part(k1: pa.Array, k2: pa.Array) -> pa.Array:
        return pa.array(place(k1.to_numpy(zero_copy_only=False), k2.to_numpy(zero_copy_only=False), p1, p2).astype(np.int32))

    starts = spark.createDataFrame(pa.table({"part": pa.array(np.arange(len(first), dtype=np.int32)), "first": pa.array(first)}))
    dealt = packed(df, F.col(id_col).alias("id"), *(v.alias(c) for c, v in columns.items())).withColumn("part", part("k1", "k2"))
    # A part is one cut of the histogram, so its size is bounded.
    numbered = dealt.withColumn("n", F.row_number().over(Window.partitionBy("part").orderBy("k1", "k2", "id")))
    out = numbered.join(F.broadcast(starts), "part")
    return unpacked(out, df.columns, size=F.col("size"), shard=F.floor(F.col("part") / per).cast("int"), slot=F.col("first") + F.col("n") - 1)


def op4_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    out = shard_documents(docs)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
