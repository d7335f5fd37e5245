"""Repeated passages by depth-limited radix sort of suffixes.

A byte is removed if a string of ``window`` bytes around it also starts earlier:
in a document of smaller id, or earlier in its own. Strings are judged on the
input and never cross documents. Suffixes are ordered only through ``window``
bytes, by passes over digits of eight bytes from the most significant on; what
is still equal after the last pass is exactly a repeated window, and all of a
group but its earliest are removed.

So that not every suffix is sorted, windows are first dealt by content. A
window's key is the least hash among its ``GRAM``-byte strings; consecutive
windows with one key form a run, some 35 windows long. Equal windows have equal
keys, so

1. each cell of documents (by hash of the text, so that copies meet; of id and text where a text's copies are too many
   for a cell) sends each key once, with whether it has it twice, and about how many different runs it has with it if they
   are ``MANY`` or more;
2. keys seen twice are answered to their cells; all other runs hold no repeat;
3. cells cut the remaining runs out, mark those equal to an earlier one of their
   own, and send one of each to its key's bucket. Runs of a key whose different
   runs in all cells come to a ``SHARE``-th of the keys a bucket gets (the rims of a
   passage that stands in a large share of all documents) are dealt window by window
   by their own hash instead, so a common passage doesn't pile up in one bucket. A
   window for itself takes some twenty times its share of a run, so no others are;
4. buckets sort the windows' suffixes and answer the repeated ones;
5. cells cut the covered bytes out.

Plain copies of a run are recognised as a whole by their bytes before the sort (in step 3
and where a bucket gathers its runs), so that it orders one run of each; what repeats in
part is found by the sort alone.

Steps 1, 3 and 5 read one exchange of the texts; nothing depends on the machine
that an earlier step ran on. A cell or bucket holds a bounded share of the input
(two for each shuffle partition). What cells and buckets send is compressed, numbers
column by column. Hashes only deal windows out; what is removed is decided on bytes.

Null texts are empty. Of rows with equal ids none is earlier than the other at
the same start; null ids come before all others. Rows equal in id and text get
equal results. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sokhan.llm.common import partitions, prepare, table, utf8

WINDOW, GRAM, MANY, SHARE, CHUNK = 100, 32, 8, 16, 1 << 20
#: What a row counts for beside its bytes.
ROW = 64
#: A key on its way is 43 bits of its hash, four bits for the number of different runs, and whether it is there twice.
CUT, FLAGS = np.uint64(21), np.uint64(5)
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63)]
SHIFT = np.uint64(31)
ZSTD, UNZSTD = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def squeezed(numbers: np.ndarray, differences: int = 1) -> bytes:
    """Rows of 64-bit numbers compressed: by column, the first ones as differences, and by byte of a number."""
    columns = np.array(numbers.T, np.int64, order="C")
    columns[:differences, 1:] = np.diff(columns[:differences])
    return ZSTD.compress(columns.view(np.uint8).reshape(*columns.shape, 8).transpose(0, 2, 1).tobytes())


def unsqueezed(blob: bytes, width: int, differences: int = 1) -> np.ndarray:
    """The rows of squeezed()."""
    planes = np.frombuffer(UNZSTD.decompress(blob), np.uint8).reshape(width, 8, -1)
    columns = np.array(planes.transpose(0, 2, 1), order="C").view(np.int64)[:, :, 0]
    columns[:differences] = np.cumsum(columns[:differences], axis=1)
    return columns.T


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every string of size bytes (a power of two), by doubling."""
    h = (data.astype(np.uint64) + np.uint64(1)) * ODD[0]
    h ^= h >> SHIFT
    step, i = 1, 0
    while step < size:
        h = h[:-step] * ODD[1 + i % 3] + h[step:]
        h ^= h >> SHIFT
        step, i = 2 * step, i + 1
    return h


def least_of(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every width values in a row."""
    step = 1
    while 2 * step <= width:
        h = np.minimum(h[:-step], h[step:])
        step *= 2
    return h if step == width else np.minimum(h[: len(h) - (width - step)], h[width - step :])


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads least hashes, which are small, over all 64 bits."""
    h = (h ^ (h >> np.uint64(33))) * ODD[3]
    return h ^ (h >> np.uint64(29))


def runs(texts: list[bytes], window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(document, start, windows, key, content hash, again) of the runs, for some documents at a time.

    again: the run goes on after a string with its least hash has left the window,
    without which no two of its windows are equal. Long documents are cut; a cut
    only parts a run in two.
    """
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for k, text in enumerate(texts):
        for at in range(0, max(0, len(text) - window + 1), CHUNK):
            piece = text[at : at + CHUNK + window - 1]
            held.append((k, at, piece))
            size += len(piece)
            if size >= CHUNK:
                yield _runs(held, window)
                held, size = [], 0
    if held:
        yield _runs(held, window)


def _runs(held: list[tuple[int, int, bytes]], window: int) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(p for _, _, p in held), np.uint8)
    sizes = np.array([len(p) for _, _, p in held])
    begin = np.cumsum(sizes) - sizes
    grams = gram_hashes(data, GRAM)
    key = least_of(grams, window - GRAM + 1)
    # Windows that begin in a piece and end in it.
    piece = np.repeat(np.arange(len(held)), sizes)[: len(key)]
    at = np.arange(len(key))
    inside = at + window <= (begin + sizes)[piece]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (piece[1:] != piece[:-1])
    starts = np.flatnonzero(fresh & inside)
    ends = np.append(starts[1:], len(key))
    last = (begin + sizes)[piece[starts]] - window + 1
    n = np.minimum(ends, last) - starts
    tail = starts + n - 1
    content = (grams[starts] * ODD[1] + grams[starts + window - GRAM]) * ODD[2] + grams[tail + window - GRAM]
    content = (content + grams[starts + (window - GRAM) // 2]) * ODD[3] + n.astype(np.uint64)
    led = np.append(0, np.cumsum(grams[: len(key)] == key))
    again = led[starts + n - 1] > led[starts]
    p = piece[starts]
    document, offset = (np.array([h[i] for h in held])[p] for i in (0, 1))
    return document, starts - begin[p] + offset, n, mixed(key[starts]), content, again


def cell_keys(texts: list[bytes], window: int, many: int = MANY) -> np.ndarray:
    """The cell's distinct keys; bit 0: it has the key twice, bits 1 to 4: the power of two of its different runs over many, from 1; 0 if there are fewer."""
    found = [r[3:] for r in runs(texts, window)]
    if not found:
        return np.zeros(0, np.uint64)
    key, content, again = (np.concatenate(x) for x in zip(*found, strict=True))
    key = key >> CUT
    order = np.lexsort((content, key))
    key, content, again = key[order], content[order], again[order]
    first = np.append(True, key[1:] != key[:-1])
    differs = first | np.append(True, content[1:] != content[:-1])
    at = np.flatnonzero(first)
    count, kinds = np.diff(np.append(at, len(key))), np.add.reduceat(differs.astype(np.int64), at)
    twice = (count > 1) | np.logical_or.reduceat(again, at)
    power = np.minimum(np.frexp(kinds // many)[1], 15)
    return key[at] << FLAGS | power.astype(np.uint64) << np.uint64(1) | twice.astype(np.uint64)


def repeated_keys(cells: np.ndarray, keys: list[np.ndarray], many: int = MANY) -> Iterator[tuple[int, np.ndarray]]:
    """For each cell, those of its keys that occur twice anywhere; bit 1 says that the runs are to be dealt window by window."""
    owner = np.repeat(cells, [len(k) for k in keys])
    flat = np.concatenate(keys)
    order = np.argsort(flat >> FLAGS, kind="stable")
    flat, owner = flat[order], owner[order]
    ident = flat >> FLAGS
    at = np.flatnonzero(np.append(True, ident[1:] != ident[:-1]))
    sizes = np.diff(np.append(at, len(flat)))
    power = (flat >> np.uint64(1) & np.uint64(15)).astype(np.int64)
    kinds = np.add.reduceat(np.where(power > 0, many << np.maximum(power - 1, 0), 0), at)
    split = kinds >= max(many, len(flat) // SHARE)
    twice = np.repeat((sizes > 1) | (np.bitwise_or.reduceat(flat, at) & np.uint64(1) > 0), sizes)
    out = (ident << FLAGS | np.repeat(split, sizes).astype(np.uint64) << np.uint64(1))[twice]
    owner = owner[twice]
    order = np.argsort(owner, kind="stable")
    out, owner = out[order], owner[order]
    at = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, np.int64)
    for a, b in zip(at, np.append(at[1:], len(owner))[: len(at)], strict=True):
        yield int(owner[a]), out[a:b]


def radix_order(group: np.ndarray, digit: np.ndarray) -> np.ndarray:
    """The stable order by group, then by a digit of eight bytes, by counting passes over sixteen bits each."""
    order = np.arange(len(digit))
    passes = [(digit, shift) for shift in (0, 16, 32, 48)] + [(group, shift) for shift in range(0, max(1, int(group.max(initial=0)).bit_length()), 16)]
    for values, shift in passes:
        piece = (values[order] >> values.dtype.type(shift)).astype(np.uint16)
        # numpy sorts sixteen bits by radix.
        order = order[np.argsort(piece, kind="stable")]
    return order


def sorted_groups(data: bytes, at: np.ndarray, group: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Radix sort of the suffixes at some places, within groups: (index, group) of those with an equal.

    Digits go from the most significant on. A pass takes the next eight bytes of the suffixes still undecided; suffixes
    alone in their group leave. The last digit may overlap the one before.
    """
    digits = np.ndarray(max(0, len(data) - 7), ">u8", data, 0, (1,))
    index = np.arange(len(at))
    for depth in [*range(0, window - 7, 8), *([window - 8] if window % 8 else [])]:
        if not len(index):
            break
        digit = digits[at[index] + depth].astype(np.uint64)
        order = radix_order(group, digit)
        index, group, digit = index[order], group[order], digit[order]
        fresh = np.append(True, (group[1:] != group[:-1]) | (digit[1:] != digit[:-1]))
        number = np.cumsum(fresh) - 1
        alone = np.bincount(number)[number] == 1
        index, group = index[~alone], number[~alone]
    return index, group


def unpacked_bytes(blob: bytes) -> bytes:
    return UNZSTD.decompress(blob)


class Runs:
    """Cut runs on their way to a bucket: numbers (row in the cell, id, start, windows, key, again) and bytes."""

    def __init__(self):
        self.head, self.body = [], []

    def add(self, row: int, doc_id: int, start: int, n: int, key: int, again: bool, data: bytes) -> None:
        self.head.append((row, doc_id, start, n, key, again))
        self.body.append(data)

    def packed(self) -> tuple[bytes, bytes]:
        return squeezed(np.array(self.head, np.int64), 2), ZSTD.compress(b"".join(self.body))


def joined(marks: list[tuple[int, int, int]]) -> np.ndarray:
    """Ascending marks (row, start, windows), those that go on where another ends as one."""
    out = np.array(marks, np.int64).reshape(-1, 3)
    fresh = np.flatnonzero(np.append(True, (out[1:, 0] != out[:-1, 0]) | (out[1:, 1] != out[:-1, 1] + out[:-1, 2])))
    return np.column_stack((out[fresh, :2], np.add.reduceat(out[:, 2], fresh)))


def cell_runs(ids: list[int], texts: list[bytes], known: np.ndarray, buckets: int, window: int) -> tuple[dict[int, Runs], list[tuple[int, int, int]]]:
    """The cell's runs whose key is known, by bucket, one of each content; and marks for the others.

    Documents must ascend by id. ``known`` are sorted answers of repeated_keys.
    """
    out: dict[int, Runs] = {}
    marks: list[tuple[int, int, int]] = []
    first: dict[bytes, tuple[int, int]] = {}
    ident = known >> FLAGS

    def take(k: int, start: int, n: int, key: int, again: bool, data: bytes) -> None:
        seen = first.setdefault(data, (ids[k], start))
        if seen < (ids[k], start):
            marks.append((k, start, n))
        else:
            out.setdefault(key % buckets, Runs()).add(k, ids[k], start, n, key >> 32, again, data)

    for document, start, n, key, _, again in runs(texts, window):
        at = np.minimum(np.searchsorted(ident, key >> CUT), len(ident) - 1)
        hit = np.flatnonzero(ident[at] == key >> CUT)
        many = (known[at[hit]] & np.uint64(2) > 0).tolist()
        for k, s, c, x, twice, split in zip(*(v[hit].tolist() for v in (document, start, n, key, again)), many, strict=True):
            text = texts[k]
            if not split:
                take(k, s, c, x, twice, text[s : s + c + window - 1])
                continue
            data = np.frombuffer(text[s : s + c + window - 1], np.uint8)
            g = gram_hashes(data, GRAM)
            h = mixed((g[:c] * ODD[1] + g[GRAM : GRAM + c]) * ODD[2] + (g[window - GRAM : window - GRAM + c] * ODD[3] + g[(window - GRAM) // 2 : (window - GRAM) // 2 + c])).tolist()
            for i in range(c):
                take(k, s + i, 1, h[i], False, text[s + i : s + i + window])
    return out, marks


def bucket_marks(heads: list[np.ndarray], bodies: list[bytes], window: int) -> np.ndarray:
    """(row, start, windows) of every repeated window among a bucket's runs that isn't the earliest."""
    head = np.concatenate(heads)
    data = b"".join(bodies)
    size = head[:, 3] + window - 1
    begin = np.cumsum(size) - size
    order = np.lexsort((head[:, 2], head[:, 1]))
    out, first, stay = [], {}, []
    for i in order.tolist():
        row, doc_id, start, n, _, _ = head[i].tolist()
        seen = first.setdefault(data[begin[i] : begin[i] + size[i]], (doc_id, start))
        if seen < (doc_id, start):
            out.append((row, start, n))
        else:
            stay.append(i)
    stay = np.array(stay, np.int64)
    # A key with one run left has no repeats, unless the run may hold its own.
    _, of, count = np.unique(head[stay, 4], return_inverse=True, return_counts=True)
    keep = (count[of] > 1) | (head[stay, 5] > 0)
    stay, of = stay[keep], of[keep]
    n = head[stay, 3]
    if not len(stay):
        return np.array(out, np.int64).reshape(-1, 3)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    run = np.repeat(stay, n)
    index, group = sorted_groups(data, begin[run] + within, np.repeat(of, n), window)
    row, doc_id, start = head[run[index], 0], head[run[index], 1], head[run[index], 2] + within[index]
    order = np.lexsort((start, doc_id, group))
    row, doc_id, start, group = row[order], doc_id[order], start[order], group[order]
    fresh = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    lead = np.repeat(fresh, np.diff(np.append(fresh, len(group))))
    later = (doc_id != doc_id[lead]) | (start != start[lead])
    found = np.column_stack((row[later], start[later]))
    found = found[np.lexsort((found[:, 1], found[:, 0]))]
    # Windows in a row become one mark.
    if len(found):
        fresh = np.flatnonzero(np.append(True, (found[1:, 0] != found[:-1, 0]) | (found[1:, 1] != found[:-1, 1] + 1)))
        out.extend(zip(found[fresh, 0].tolist(), found[fresh, 1].tolist(), np.diff(np.append(fresh, len(found))).tolist(), strict=True))
    return np.array(out, np.int64).reshape(-1, 3)


def covered(marks: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal spans of the bytes in marked windows; marks are (start, windows)."""
    out: list[tuple[int, int]] = []
    for start, n in sorted(map(tuple, marks.tolist())):
        end = start + n + window - 1
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def dealt(docs: DataFrame, cells: int) -> DataFrame:
    """cell, doc_id, text: equal texts in one cell, which sends one of their runs; but texts that would fill half a cell are dealt by id too."""
    by_text = docs.select(F.xxhash64("text").alias("hash"), "doc_id", "text")
    size = F.octet_length("text").cast("long") + ROW
    sizes = by_text.groupBy("hash").agg(F.sum(size).alias("size"))
    total = sizes.agg(F.sum("size").alias("total"))
    large = sizes.crossJoin(F.broadcast(total)).filter(F.col("size") * (2 * cells) > F.col("total")).select("hash", F.lit(True).alias("large"))
    # At most twice as many hashes as there are cells.
    spread = F.when(F.col("large"), F.xxhash64("hash", "doc_id")).otherwise(F.col("hash"))
    return by_text.join(F.broadcast(large), "hash", "left").select(F.pmod(spread, F.lit(cells)).cast("int").alias("cell"), "doc_id", "text")


def remove_repeats(df: DataFrame, window: int = WINDOW, many: int = MANY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, kept (the remaining bytes) and spans (removed, in bytes) of every row."""
    if window < GRAM + 8:
        raise ValueError(f"a window has at least {GRAM + 8} bytes")
    spark = df.sparkSession
    prepare(spark)
    cells = buckets = 2 * partitions(spark)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    doc_id = F.col(id_col).cast("long")
    docs = dealt(df.select(doc_id.alias("doc_id"), text.alias("text")), cells)
    by_cell = docs.groupBy("cell")

    def ordered(t: pa.Table) -> tuple[list[int], list[bytes], list[int | None]]:
        # Steps 3 and 5 number a cell's rows alike, since rows equal in id and text have equal results.
        ids, texts = t.column("doc_id").to_pylist(), utf8(t.column("text").combine_chunks())
        low = [-(1 << 63) if i is None else i for i in ids]
        order = sorted(range(len(ids)), key=lambda i: (low[i], ids[i] is not None, texts[i]))
        return [low[i] for i in order], [texts[i] for i in order], [ids[i] for i in order]

    def ask(t: pa.Table) -> pa.Table:
        keys = cell_keys(utf8(t.column("text").combine_chunks()), window, many)
        to = (keys >> FLAGS) % np.uint64(buckets)
        order = np.argsort(to, kind="stable")
        keys, to = keys[order], to[order]
        at = np.flatnonzero(np.append(True, to[1:] != to[:-1])) if len(to) else np.zeros(0, np.int64)
        blobs = [squeezed(keys[a:b, None]) for a, b in zip(at, np.append(at[1:], len(to))[: len(at)], strict=True)]
        cell = t.column("cell")[0].as_py()
        return pa.table({"bucket": pa.array(to[at].astype(np.int32)), "cell": pa.array([cell] * len(at), pa.int32()), "keys": pa.array(blobs, pa.binary())})

    def answer(t: pa.Table) -> pa.Table:
        keys = [unsqueezed(k, 1)[:, 0].astype(np.uint64) for k in t.column("keys").to_pylist()]
        found = list(repeated_keys(t.column("cell").to_numpy(), keys, many))
        return pa.table({"cell": pa.array([c for c, _ in found], pa.int32()), "keys": pa.array([squeezed(k[:, None]) for _, k in found], pa.binary())})

    def cut(t: pa.Table, answers: pa.Table) -> pa.Table:
        out, marks, cell = {}, [], -1
        if t.num_rows and answers.num_rows:
            cell = t.column("cell")[0].as_py()
            low, texts, _ = ordered(t)
            known = np.sort(np.concatenate([unsqueezed(k, 1)[:, 0] for k in answers.column("keys").to_pylist()]).astype(np.uint64))
            out, marks = cell_runs(low, texts, known, buckets, window)
        made = [(b, cell, *r.packed()) for b, r in out.items()]
        # Marks pass through the bucket of the cell's own number; they have no body.
        made += [(cell, cell, squeezed(joined(sorted(marks))), None)] if marks else []
        # A run's cell travels with each of its rows, since answers go back to it.
        return pa.table({n: pa.array([m[i] for m in made], t) for i, (n, t) in enumerate((("bucket", pa.int32()), ("cell", pa.int32()), ("head", pa.binary()), ("body", pa.binary())))})

    def decide(t: pa.Table) -> pa.Table:
        cell, head, body = (t.column(c).to_pylist() for c in ("cell", "head", "body"))
        made = [(c, h) for c, h, b in zip(cell, head, body, strict=True) if b is None]
        sent = [i for i, b in enumerate(body) if b is not None]
        if sent:
            heads = [unsqueezed(head[i], 6, 2) for i in sent]
            for h, i in zip(heads, sent, strict=True):
                h[:, 0] |= cell[i] << 32
            marks = bucket_marks(heads, [unpacked_bytes(body[i]) for i in sent], window)
            marks = marks[np.lexsort((marks[:, 1], marks[:, 0]))]
            to, marks[:, 0] = marks[:, 0] >> 32, marks[:, 0] & 0xFFFFFFFF
            at = np.flatnonzero(np.append(True, to[1:] != to[:-1])) if len(to) else np.zeros(0, np.int64)
            made += [(int(to[a]), squeezed(marks[a:b])) for a, b in zip(at, np.append(at[1:], len(to))[: len(at)], strict=True)]
        return pa.table({"cell": pa.array([m[0] for m in made], pa.int32()), "marks": pa.array([m[1] for m in made], pa.binary())})

    def finish(t: pa.Table, found: pa.Table) -> pa.Table:
        types = pa.schema([("doc_id", pa.int64()), ("kept", pa.binary()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
        if not t.num_rows:
            return types.empty_table()
        marks = np.concatenate([unsqueezed(m, 3) for m in found.column("marks").to_pylist()] or [np.zeros((0, 3), np.int64)])
        marks = marks[np.argsort(marks[:, 0], kind="stable")]
        ids, kept, spans = [], [], []
        _, texts, names = ordered(t)
        at = np.searchsorted(marks[:, 0], np.arange(len(texts) + 1)).tolist()
        for doc_id, text, a, b in zip(names, texts, at[:-1], at[1:], strict=True):
            cutouts = covered(marks[a:b, 1:], window)
            edges = [0, *(x for s in cutouts for x in s), len(text)]
            ids.append(doc_id)
            kept.append(b"".join(text[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)))
            spans.append([{"start": s, "end": e} for s, e in cutouts])
        return pa.table({"doc_id": ids, "kept": kept, "spans": spans}, schema=types)

    asked = by_cell.applyInArrow(ask, "bucket int, cell int, keys binary")
    answers = asked.groupBy("bucket").applyInArrow(answer, "cell int, keys binary")
    cuts = by_cell.cogroup(answers.groupBy("cell")).applyInArrow(cut, "bucket int, cell int, head binary, body binary")
    marks = cuts.groupBy("bucket").applyInArrow(decide, "cell int, marks binary")
    return by_cell.cogroup(marks.groupBy("cell")).applyInArrow(finish, "doc_id long, kept binary, spans array<struct<start:long,end:long>>")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removed bytes and the rest's checksum of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = remove_repeats(docs)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["end"] - x["start"])
    return out.select("doc_id", (F.length("kept") + removed).cast("long").alias("n_bytes"), removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
