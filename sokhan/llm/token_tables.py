"""Token-ID output: sorted-string-table shards keyed by document id.

File layout, all integers little-endian:

* data blocks: entries ``varint shared, varint rest, varint value size, key
  rest, value``; keys ascend and share a prefix with the key before, except at
  restart points (every 16 entries), whose offsets (u32) and count (u32) end
  the block. A block is compressed with zstandard.
* index: one entry for each block: ``u16 key size, last key, u64 offset, u32
  size``. Sparse: one key for each block.
* Bloom filter: ten bits and seven probes a key.
* footer: ``u64`` index offset and size, filter offset and size, documents and
  tokens, then the magic ``SKHNSST1``.

A key is 0x00 for a null id, else 0x01 and the id as big-endian signed 64 bits
with the sign bit flipped, so byte order is id order, nulls first. A value is
the id width in bytes (2 or 4) and the ids.

Repeated ids are kept, one entry each; ``get`` returns all of them. A null or
empty text is the end id alone. Empty tables give no files and no rows.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sokhan.llm.common import LOWER, id_and_text, partitions, prepare, shared_folder, table, utf8

MAGIC = b"SKHNSST1"
FOOTER = struct.Struct("<QQQQQQ8s")
RESTART, BLOCK, FILE = 16, 64 << 10, 128 << 20
#: Kinds of bytes: a for letters and digits (of ASCII and U+00C0 to U+00FF), x for other ASCII, ? for any other.
KINDS = bytes(97 if chr(c).isalnum() and c < 128 or 128 <= c < 192 or c == 0xC3 else 46 if c in b".," else 32 if c in b" \n" else 120 if c < 128 else 63 for c in range(256))
#: A token table's end-of-document id.
END_ID = 1
#: What a tokenizer does before its merges, if parts between blanks may be encoded alone.
PARTED = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}


def key_of(doc_id: int | None) -> bytes:
    return b"\0" if doc_id is None else b"\1" + struct.pack(">Q", doc_id + (1 << 63))


def id_of(key: bytes) -> int | None:
    return None if key == b"\0" else struct.unpack(">Q", key[1:])[0] - (1 << 63)


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def read_varint(b: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        x = b[at]
        at += 1
        n |= (x & 127) << shift
        if x < 128:
            return n, at
        shift += 7


def probes(key: bytes, bits: int) -> list[int]:
    a, b = xxhash.xxh64_intdigest(key, 1), xxhash.xxh64_intdigest(key, 2) | 1
    return [(a + i * b) % (1 << 64) % bits for i in range(7)]


class Writer:
    """Writes one file; keys must not descend."""

    def __init__(self, uri: str):
        self.fs, self.path = fs.FileSystem.from_uri(uri)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.temp = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.out, self.at = self.fs.open_output_stream(self.temp), 0
        self.zstd = zstandard.ZstdCompressor(level=1)
        self.index, self.keys, self.n_docs, self.n_tokens = bytearray(), [], 0, 0
        self.block, self.restarts, self.n, self.last = bytearray(), [], 0, b""

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        key = key_of(doc_id)
        width = 2 if not len(ids) or int(ids.max()) < 65536 else 4
        value = bytes([width]) + ids.astype(f"<u{width}").tobytes()
        shared = 0
        if self.n % RESTART == 0:
            self.restarts.append(len(self.block))
        else:
            while shared < min(len(key), len(self.last)) and key[shared] == self.last[shared]:
                shared += 1
        self.block += varint(shared) + varint(len(key) - shared) + varint(len(value)) + key[shared:] + value
        self.last, self.n = key, self.n + 1
        self.n_docs, self.n_tokens = self.n_docs + 1, self.n_tokens + len(ids)
        self.keys.append(key)
        if len(self.block) >= BLOCK:
            self.end_block()

    def end_block(self) -> None:
        if not self.n:
            return
        self.block += struct.pack(f"<{len(self.restarts) + 1}I", *self.restarts, len(self.restarts))
        data = self.zstd.compress(bytes(self.block))
        self.index += struct.pack("<H", len(self.last)) + self.last + struct.pack("<QI", self.at, len(data))
        self.write(data)
        self.block, self.restarts, self.n, self.last = bytearray(), [], 0, b""

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def close(self) -> None:
        """Ends the file; it appears under its name whole or not at all."""
        self.end_block()
        bits = max(64, 10 * len(self.keys))
        bloom = np.zeros(-(-bits // 8) * 8, bool)
        for key in self.keys:
            bloom[probes(key, bits)] = True
        index_at = self.at
        self.write(bytes(self.index))
        bloom_at, packed = self.at, struct.pack("<Q", bits) + np.packbits(bloom).tobytes()
        self.write(packed)
        self.write(FOOTER.pack(index_at, len(self.index), bloom_at, len(packed), self.n_docs, self.n_tokens, MAGIC))
        self.out.close()
        self.fs.move(self.temp, self.path)


class Table:
    """Reads one file: footer, index and filter at once, blocks as they are asked for."""

    def __init__(self, uri: str):
        filesystem, path = fs.FileSystem.from_uri(uri)
        self.file = filesystem.open_input_file(path)
        end = self.file.size()
        index_at, index_n, bloom_at, bloom_n, self.n_docs, self.n_tokens, magic = FOOTER.unpack(self.part(end - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no token table")
        index, self.last_keys, self.blocks, at = self.part(index_at, index_n), [], [], 0
        while at < len(index):
            n = struct.unpack_from("<H", index, at)[0]
            self.last_keys.append(bytes(index[at + 2 : at + 2 + n]))
            self.blocks.append(struct.unpack_from("<QI", index, at + 2 + n))
            at += 14 + n
        bloom = self.part(bloom_at, bloom_n)
        self.bits, self.bloom = struct.unpack_from("<Q", bloom)[0], bloom[8:]
        self.zstd = zstandard.ZstdDecompressor()

    def part(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def block(self, k: int) -> tuple[bytes, tuple[int, ...]]:
        data = self.zstd.decompress(self.part(*self.blocks[k]))
        n = struct.unpack_from("<I", data, len(data) - 4)[0]
        return data, struct.unpack_from(f"<{n}I", data, len(data) - 4 - 4 * n)

    @staticmethod
    def entries(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, np.ndarray]]:
        key = b""
        while at < end:
            shared, at = read_varint(data, at)
            rest, at = read_varint(data, at)
            size, at = read_varint(data, at)
            key = key[:shared] + data[at : at + rest]
            at += rest
            width = data[at]
            yield key, np.frombuffer(data, f"<u{width}", (size - 1) // width, at + 1)
            at += size

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of every document with this key: filter, index, restarts, then one short scan."""
        key, out = key_of(doc_id), []
        if not all(self.bloom[p >> 3] & 128 >> (p & 7) for p in probes(key, self.bits)):
            return out
        low, high = 0, len(self.last_keys)
        while low < high:
            mid = (low + high) // 2
            low, high = (mid + 1, high) if self.last_keys[mid] < key else (low, mid)
        for k in range(low, len(self.blocks)):
            data, restarts = self.block(k)
            end, a, b = len(data) - 4 - 4 * len(restarts), 0, len(restarts)
            while a < b:
                mid = (a + b) // 2
                first = next(self.entries(data, restarts[mid], end))[0]
                a, b = (mid + 1, b) if first < key else (a, mid)
            for found, ids in self.entries(data, restarts[max(0, a - 1)], end):
                if found == key:
                    out.append(ids)
                elif found > key:
                    return out
            if self.last_keys[k] > key:
                break
        return out

    def scan(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for k in range(len(self.blocks)):
            data, restarts = self.block(k)
            for key, ids in self.entries(data, 0, len(data) - 4 - 4 * len(restarts)):
                yield id_of(key), ids


class Encoder(dict):
    """Texts to ids with the tokenizers library; words between blanks are remembered.

    Blanks part a text into words that are encoded alone, for tokenizers that normalize and
    pre-tokenize as ``PARTED`` says (as word_bpe_49k.json); all texts of others, and
    texts that may hold special tokens, go to the library whole.
    The memory stops growing at ``limit`` words.
    """

    WORD_AND_MARKS = re.compile("([a-zß-öø-ÿ]+)([.,!?;:%$&*#]*)")
    BYTES, WORDS = 40 << 20, 2000

    def __init__(self, path: str, limit: int = 400_000):
        super().__init__({"": b""})
        from tokenizers import Tokenizer

        self.tokenizer, self.limit, self.new = Tokenizer.from_file(path), limit, {}
        rules = json.loads(self.tokenizer.to_str())
        self.parted = {k: rules[k] for k in PARTED} == PARTED and rules["model"].get("end_of_word_suffix") == "</w>"
        self.ends = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        out = self.new.get(word)
        if out is None:
            m = self.WORD_AND_MARKS.fullmatch(word)
            out = self[m[1]] + self[m[2]] if m and m[2] else self.whole(word)
        if len(self) < self.limit and len(word) < 100:
            self[word] = out
        return out

    def learn(self, words: set[str]) -> None:
        """Encode new words of letters alone many at a time; each ends with a word-end token."""
        found = [m[1] for w in words if (m := self.WORD_AND_MARKS.fullmatch(w)) and m[1] not in self]
        found, self.new = list(dict.fromkeys(found)), {}
        for at in range(0, len(found), self.WORDS):
            some = found[at : at + self.WORDS]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            ends = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(ends) == len(some):
                data = ids.tobytes()
                self.new |= {w: data[4 * a : 4 * b] for w, a, b in zip(some, [0, *ends], ends, strict=False)}

    @staticmethod
    def parts(text: bytes) -> bytes:
        """Lower-cased parts that the pre-tokenizer never joins, between blanks.

        Full stops and commas are parts of their own if all of them stand next to
        letters, digits and blanks only; else they might belong to a run of marks.
        """
        kinds = text.translate(KINDS)
        alone = not any(x in kinds for x in (b"?", b"..", b".x", b"x.")) and b"\xc3\x97" not in text and b"\xc3\xb7" not in text
        text = text.translate(LOWER).replace(b"\n", b" ")
        if alone:
            text = text.replace(b".", b" . ").replace(b",", b" , ")
        return text

    def ids(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """Ids of each text, some tens of megabytes of texts at a time."""
        some, size = [], 0
        for text in texts:
            some.append(text)
            size += len(text)
            if size >= self.BYTES:
                yield from self.some_ids(some)
                some, size = [], 0
        yield from self.some_ids(some)

    def some_ids(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """Each distinct part is looked up once; Arrow's kernels deal the ids out to its places."""
        if not self.parted:
            yield from (np.frombuffer(self.whole(t.decode("utf-8", "replace")), "<u4") for t in texts)
            return
        parts = pc.split_pattern(pa.array([b"" if b"<|" in t else self.parts(t) for t in texts], pa.large_binary()).cast(pa.large_string()), " ")
        coded = parts.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        self.learn(set(words).difference(self))
        found = [self[w] for w in words]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        lists = pa.LargeListArray.from_arrays(np.append(0, np.cumsum(sizes)), np.frombuffer(b"".join(found), "<u4"))
        at = coded.indices.to_numpy()
        flat = lists.take(coded.indices).flatten().to_numpy()
        ends = np.append(0, np.cumsum(sizes[at]))[np.asarray(parts.offsets)]
        for text, a, b in zip(texts, ends, ends[1:], strict=False):
            yield np.frombuffer(self.whole(text.decode("utf-8", "replace")), "<u4") if b"<|" in text else flat[a:b]


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """One encoder in a worker process, so what it has learnt serves later tasks too."""
    return Encoder(path)


def write_token_tables(df: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the texts' ids as tables in ascending id order; one row for each file.

    Documents are dealt out once by ranges of the id; each task writes its range
    as files of at most about ``FILE`` bytes, named by its place in the order and
    moved into place when whole, so a repeated task replaces equal files. Returns
    path, part, n_docs, n_tokens, in the order of ids by (part, path).
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encoder, writer, k, made = TaskContext.get().partitionId(), None, None, 0, []

        def close() -> None:
            writer.close()
            made.append((uri, part, writer.n_docs, writer.n_tokens))

        for batch in batches:
            encoder = encoder_of(tokenizer)
            ids = batch.column("doc_id").to_pylist()
            for doc_id, found in zip(ids, encoder.ids(utf8(batch.column("text"))), strict=True):
                if writer is None:
                    uri = f"{folder}/part-{part:07d}-{k:05d}.sst"
                    writer = Writer(uri)
                writer.add(doc_id, np.append(found, np.uint32(end_id)))
                if writer.at >= FILE:
                    close()
                    writer, k = None, k + 1
        if writer is not None:
            close()
        yield pa.RecordBatch.from_pydict({n: [m[i] for m in made] for i, n in enumerate(("path", "part", "n_docs", "n_tokens"))}, schema=pa.schema([("path", pa.string()), ("part", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    spark = df.sparkSession
    prepare(spark)
    rows = id_and_text(df, id_col, text_col).repartitionByRange(partitions(spark), F.col("doc_id").asc_nulls_first())
    # Rows with one id in a fixed order, so that a repeated task writes equal files.
    return rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text").mapInArrow(write, "path string, part long, n_docs long, n_tokens long")


def read_token_tables(spark: SparkSession, files: list[tuple[str, int]], with_ids: bool = True) -> DataFrame:
    """The documents of (path, ids before the file) pairs: doc_id, start, n_tokens, ids_crc32, ids.

    The list has a row for each file, so its length is bounded by the tasks that
    wrote them. start counts the ids of all documents before.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int32()))] * with_ids
        for batch in batches:
            for path, start in zip(*(batch.column(c).to_pylist() for c in ("path", "start")), strict=True):
                rows, held = [], 0
                for doc_id, ids in Table(path).scan():
                    wide = ids.astype("<u4")
                    rows.append((doc_id, start, len(ids), zlib.crc32(wide), *[wide.astype("i4")] * with_ids))
                    start += len(ids)
                    held += len(ids)
                    if held > 1 << 21:
                        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(types)], [n for n, _ in types])
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(types)], [n for n, _ in types])

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    made = spark.createDataFrame(files, "path string, start long")
    return made.repartition(max(1, min(len(files), partitions(spark)))).mapInArrow(read, schema)


def token_tables(df: DataFrame, tokenizer: str, end_id: int = END_ID, with_ids: bool = True, folder: str | None = None) -> DataFrame:
    """Write all documents and read them back from the files."""
    spark = df.sparkSession
    made = write_token_tables(df, folder or shared_folder(spark, "token-tables"), tokenizer, end_id).collect()
    files, start = [], 0
    for row in sorted(made, key=lambda r: (r["part"], r["path"])):
        files.append((row["path"], start))
        start += row["n_tokens"]
    return read_token_tables(spark, files, with_ids)


def op6_token_tables(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Every document's place, size and checksum as read back from the tables."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return token_tables(table(spark, sf_dir, "documents"), tokenizer, with_ids=False)
