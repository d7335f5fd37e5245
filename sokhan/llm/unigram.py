"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie.

Pieces come from a public vocabulary file, whose path is a parameter. A Unigram model's own
log scores are taken. A file of another kind holds merge ranks, not probabilities: for it
``zipf_scores`` turns rank r into the log of a Zipf-Mandelbrot share (``scores="zipf"``,
which may be asked for with any file), so nothing is trained. Callers with other scores pass
them to ``Vocabulary``.

Encoding: blanks become U+2581, one is put before a text that isn't empty, and
the split into pieces with the highest sum of log scores is taken (of equal
sums the one whose last piece is longest, as far as that decides). A character
that is no piece costs the lowest score less 10 and becomes its UTF-8 bytes'
pieces. Decoding joins the pieces, turns U+2581 into a blank and drops the first
blank. Decoding gives the text back, but for U+2581 in the text, which reads as
a blank.

Null and empty texts have no ids and decode to the empty text; repeated rows are
encoded alike, other columns pass through whatever their names (one named like a result is
replaced), an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sokhan.llm.common import packed, prepare, table, unpacked

MARK = "▁"
UNKNOWN_PENALTY = 10.0


def zipf_scores(n: int) -> list[float]:
    """Log shares that sum to one over ranks 0 to n - 1."""
    weights = [1 / (r + 2.7) for r in range(n)]
    total = math.log(sum(weights))
    return [math.log(w) - total for w in weights]


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a message's fields in the wire format of model files."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
            continue
        size = number() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, data[at : at + size]
        at += size


#: Places of the trainer's settings in a model file and of the model's type among them; a Unigram model's type, also where none is given.
TRAINER, MODEL_TYPE, UNIGRAM = 2, 3, 1


def is_unigram(model: bytes) -> bool:
    """Whether a model file holds a Unigram model."""
    trainer = b"".join(v for k, v in fields(model) if k == TRAINER)
    return dict(fields(trainer)).get(MODEL_TYPE, UNIGRAM) == UNIGRAM


class DoubleArray:
    """A trie in two arrays: from state s byte c leads to t = base[s] + c if check[t] == s."""

    def __init__(self, keys: list[bytes], values: list[int]):
        order = sorted(range(len(keys)), key=keys.__getitem__)
        keys, values = [keys[i] for i in order], [values[i] for i in order]
        size, window = 1 << 16, 4096
        base, check, value, used = (np.full(size, fill, kind) for fill, kind in ((0, "i4"), (-1, "i4"), (-1, "i4"), (False, bool)))
        check[0], used[0] = 0, True
        free, todo = 1, [(0, 0, len(keys), 0)]
        while todo:
            state, low, high, depth = todo.pop()
            if low < high and len(keys[low]) == depth:
                value[state] = values[low]
                low += 1
            if low == high:
                continue
            runs, start = [], low
            for i in range(low + 1, high + 1):
                if i == high or keys[i][depth] != keys[start][depth]:
                    runs.append((keys[start][depth], start, i))
                    start = i
            at = max(1, free - runs[0][0])
            while True:
                while at + window + 257 > len(used):
                    base, check, value, used = (np.concatenate((a, np.full(len(a), fill, a.dtype))) for a, fill in ((base, 0), (check, -1), (value, -1), (used, False)))
                taken = np.zeros(window, bool)
                for c, _, _ in runs:
                    taken |= used[at + c : at + c + window]
                if (fit := int(taken.argmin())) or not taken[0]:
                    at += fit
                    break
                at += window
            base[state] = at
            for c, a, b in runs:
                check[at + c], used[at + c] = state, True
                todo.append((at + c, a, b, depth + 1))
            while used[free : free + 64].all():
                free += 64
        self.base, self.check, self.value = base.tolist(), check.tolist(), value.tolist()

    def prefixes(self, text: bytes, at: int):
        """(end, value) of every key that starts at a place, short ones first."""
        state = 0
        for end in range(at, len(text)):
            t = self.base[state] + text[end]
            if self.check[t] != state:
                return
            state = t
            if self.value[t] >= 0:
                yield end + 1, self.value[t]


@dataclass
class Vocabulary:
    """Pieces by id: their bytes, log scores, and the id of each byte's piece."""

    pieces: list[bytes]
    scores: list[float]
    normal: list[bool]
    byte_ids: list[int]

    @classmethod
    def load(cls, path: str, scores: str | None = None) -> Vocabulary:
        """From a model file; scores are its own ("own") or by rank ("zipf"), without a choice its own if it is a Unigram model."""
        from sentencepiece import SentencePieceProcessor

        if scores not in (None, "own", "zipf"):
            raise ValueError("scores is own or zipf")
        p = SentencePieceProcessor(model_file=path)
        own = scores == "own" or scores is None and is_unigram(p.serialized_model_proto())
        n = p.vocab_size()
        names = [p.id_to_piece(i) for i in range(n)]
        is_byte = [p.is_byte(i) for i in range(n)]
        normal = [not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i) or is_byte[i]) for i in range(n)]
        byte_ids = [p.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        pieces = [bytes([int(s[3:5], 16)]) if b else s.encode() if ok else b"" for s, b, ok in zip(names, is_byte, normal, strict=True)]
        ranks = iter(zipf_scores(sum(normal)))
        return cls(pieces, [(p.get_score(i) if own else next(ranks)) if ok else 0.0 for i, ok in enumerate(normal)], normal, byte_ids)


class Unigram:
    """Encodes and decodes with a vocabulary; parts of texts are remembered, at most ``limit``.

    A text is cut before each mark that follows another character, and around
    line feeds, where no piece spans such a place: the best split of the whole is
    then the best splits of the parts in a row. Otherwise it is taken whole.
    """

    def __init__(self, vocabulary: Vocabulary, limit: int = 200_000):
        v = self.v = vocabulary
        ids = [i for i, ok in enumerate(v.normal) if ok]
        self.trie = DoubleArray([v.pieces[i] for i in ids], ids)
        self.lowest = min(v.scores[i] for i in ids) - UNKNOWN_PENALTY
        self.is_byte = np.zeros(len(v.pieces), bool)
        self.is_byte[v.byte_ids] = True
        texts = [v.pieces[i].decode() for i in ids]
        self.cut_marks = not any(MARK in t.lstrip(MARK) for t in texts)
        self.cut_lines = self.cut_marks and not any("\n" in t for t in texts)
        self.surface = [p if self.is_byte[i] else p.replace(MARK.encode(), b" ") for i, p in enumerate(v.pieces)]
        self.memory, self.limit = {}, limit

    def __getstate__(self):
        return self.__dict__ | {"memory": {}}

    def best(self, text: bytes) -> list[int]:
        """Viterbi over the text's bytes; only whole characters are reached."""
        n, scores = len(text), self.v.scores
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        score, start_of, piece_of = [-math.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        score[0] = 0.0
        for at in range(n):
            here = score[at]
            if here == -math.inf:
                continue
            lead = text[at]
            whole = at + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
            single, state, end = False, 0, at
            # The trie walk of DoubleArray.prefixes, written out: it is the hot loop.
            while end < n:
                t = base[state] + text[end]
                if check[t] != state:
                    break
                state, end, piece = t, end + 1, value[t]
                if piece >= 0:
                    new = here + scores[piece]
                    if new > score[end]:
                        score[end], start_of[end], piece_of[end] = new, at, piece
                    if end == whole:
                        single = True
            if not single and here + self.lowest > score[whole]:
                score[whole], start_of[whole], piece_of[whole] = here + self.lowest, at, -1
        out, at = [], n
        while at:
            start, piece = start_of[at], piece_of[at]
            out += [piece] if piece >= 0 else [self.v.byte_ids[b] for b in text[start:at][::-1]]
            at = start
        return out[::-1]

    def part(self, text: str) -> bytes:
        found = self.memory.get(text)
        if found is None:
            found = np.array(self.best(text.encode()), "<u4").tobytes()
            if len(self.memory) < self.limit and len(text) < 100:
                self.memory[text] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text."""
        if not text:
            return np.zeros(0, "<u4")
        s = MARK + text.replace(" ", MARK)
        if not self.cut_marks:
            parts = [s]
        elif MARK * 2 in s:
            parts = re.findall(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n" if self.cut_lines else f"{MARK}*[^{MARK}]+|{MARK}+", s)
        else:
            s = s.replace(MARK, "\0" + MARK) if "\0" not in s else s
            s = s.replace("\n", "\0\n\0") if self.cut_lines and s.startswith("\0") else s
            parts = [p for p in s.split("\0") if p] if s.startswith("\0") else re.findall(f"{MARK}?[^{MARK}]*", s)
        return np.frombuffer(b"".join(map(self.part, parts)), "<u4")

    def decode(self, ids: list[int]) -> str:
        """The text of ids."""
        out = b"".join(map(self.surface.__getitem__, ids))
        return out.removeprefix(b" ").decode("utf-8", "replace")


def share(spark: SparkSession, vocabulary: Vocabulary):
    """Send the model to the workers; its size is that of the vocabulary, a few MB."""
    prepare(spark)
    return spark.sparkContext.broadcast(Unigram(vocabulary))


def encode(text: Column, shared) -> Column:
    """struct<ids array<int>, n_byte_ids long, ids_crc32 long, decoded string>; decoded is the text read back from the ids."""

    @F.arrow_udf("ids array<int>, n_byte_ids long, ids_crc32 long, decoded string")
    def run(texts: pa.Array) -> pa.Array:
        model = shared.value
        ids = [model.encode(t.as_py() or "") for t in texts]
        sizes = np.cumsum([0] + [len(x) for x in ids])
        flat = np.concatenate([*ids, np.zeros(0, "<u4")])
        lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat.astype("i4")))
        is_byte = [int(model.is_byte[x].sum()) for x in ids]
        return pa.StructArray.from_arrays([lists, pa.array(is_byte, pa.int64()), pa.array([zlib.crc32(np.ascontiguousarray(x)) for x in ids], pa.int64()), pa.array((model.decode(x.tolist()) for x in ids), pa.string())], ["ids", "n_byte_ids", "ids_crc32", "decoded"])

    return run(text)


def decode(ids: Column, shared) -> Column:
    """The text of an id column; null ids give the empty text."""

    @F.arrow_udf("string")
    def run(lists: pa.Array) -> pa.Array:
        model = shared.value
        return pa.array([model.decode(x or []) for x in lists.to_pylist()], pa.string())

    return run(ids)


def encode_documents(df: DataFrame, path: str, text_col: str = "text", scores: str | None = None) -> DataFrame:
    """All columns, then ids, n_byte_ids, ids_crc32 and decoded, the text read back from the ids.

    A column of df with one of these names is replaced.
    """
    shared = share(df.sparkSession, Vocabulary.load(path, scores))
    out = packed(df, encode(F.col(text_col).cast("string"), shared).alias("encoded"))
    return unpacked(out, df.columns, **{n: F.col("encoded")[n] for n in ("ids", "n_byte_ids", "ids_crc32", "decoded")})


def vocabulary_path(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return path


def op1_sentencepiece(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Encode every document and decode the ids: sizes, checksums, and whether the text came back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = encode_documents(docs, vocabulary_path(path))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "n_byte_ids", "ids_crc32", F.sha2("decoded", 256).alias("decoded_sha256"), (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))
