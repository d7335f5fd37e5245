"""Each training-data operator against brute force, a round trip or held-out labels, with the edge cases."""

import hashlib
import os
import random
import re
import time
import zlib

import pytest
from pyspark.sql import functions as F

from sokhan.llm import compression_quality, decontamination, histogram_shards, license_templates, line_rules, near_copies, personal_data, simhash, suffix_dedup, token_tables, unigram

EDGES = [(900, None), (901, ""), (902, " \n\t "), (903, "x" * 120_000), (None, "no id"), (904, "twin text"), (904, "twin text")]
TABLES = "/root/testdata/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("clash")).repartition(3)


def test_suffix_dedup(spark):
    r = random.Random(5)
    passages = ["".join(r.choice("abc é") for _ in range(300)) for _ in range(3)]
    docs = [(r.randint(0, 90), "".join(x)) for _ in range(80) for x in [[r.choice(passages)[a : a + r.randint(50, 200)] if r.random() < 0.6 else "ab" * r.randint(10, 120) for a in (r.randint(0, 100), r.randint(0, 100))]]]
    docs += [e for e in EDGES if e[0] is not None] + [(7, "y" * 100), (8, "y" * 99)]
    first = {}
    data = [(d, (t or "").encode()) for d, t in docs]
    for d, b in data:
        for i in range(len(b) - 99):
            w = b[i : i + 100]
            first[w] = min(first.get(w, (d, i)), (d, i))
    want = []
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - 99):
            if first[b[i : i + 100]] < (d, i):
                gone[i : i + 100] = b"\1" * 100
        want.append((d, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    for many in (2, 8):
        got = [(x["doc_id"], bytes(x["kept"])) for x in suffix_dedup.remove_repeats(frame(spark, docs), many=many).collect()]
        assert sorted(got) == sorted(want)
    assert suffix_dedup.remove_repeats(frame(spark, EDGES)).count() == len(EDGES)
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0


def test_suffix_dedup_moves_little_for_copies_and_rims(spark):
    """Copies with other ids add their own bytes and little else to what is shuffled; the rims of common passages aren't dealt by windows."""

    def written():
        sc = spark.sparkContext._jsc.sc()
        sc.listenerBus().waitUntilEmpty(30_000)
        return sc.statusStore().executorList(True).apply(0).totalShuffleWrite()

    def moved(docs):
        before = written()
        suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).write.format("noop").mode("overwrite").save()
        return (written() - before) / sum(len(t) for _, t in docs)

    r = random.Random(6)
    word = lambda n: "".join(r.choice("abcdefghijklmnop") for _ in range(n))
    texts = [word(4000) for _ in range(300)]
    assert moved([(c * 1000 + i, t) for c in range(5) for i, t in enumerate(texts)]) < 2
    common = [word(400) for _ in range(40)]
    assert moved([(i, word(300) + common[i % 40] + word(300)) for i in range(2000)]) < 2


def test_suffix_dedup_cells(spark):
    """Copies share a cell, but for texts that would fill one."""
    docs = spark.createDataFrame([(c * 1000 + i, f"text {i} " * 20) for c in range(5) for i in range(100)] + [(9000 + i, "copy " * 40) for i in range(400)], "doc_id long, text string")
    cells = suffix_dedup.dealt(docs, 20).groupBy("text").agg(F.countDistinct("cell").alias("cells"), F.count("*").alias("n")).collect()
    assert {x["n"]: x["cells"] for x in cells if x["n"] == 400}[400] == 20
    assert all(x["cells"] == 1 for x in cells if x["n"] == 5) and len(cells) == 101


def test_suffix_dedup_split_keys():
    import numpy as np

    keys = np.arange(1, 2001, dtype=np.uint64) << suffix_dedup.FLAGS
    some, lots = keys.copy(), keys.copy()
    some[7] |= np.uint64(1 << 1)  # some eight different runs, in one cell
    lots[9] |= np.uint64(7 << 1)  # some 512
    found = dict(suffix_dedup.repeated_keys(np.array([3, 5]), [some, lots]))
    assert [np.flatnonzero(found[c] & np.uint64(2)).tolist() for c in (3, 5)] == [[9], [9]] and len(found[3]) == 2000
    for rows in (np.zeros((0, 3), np.int64), np.array([[-(1 << 63), 5, 1], [3, -7, 2], [(1 << 63) - 1, 0, 9]])):
        assert (suffix_dedup.unsqueezed(suffix_dedup.squeezed(rows, 2), 3, 2) == rows).all()


def test_simhash(spark):
    r = random.Random(1)
    base = [[r.choice("alpha beta gamma delta eps zeta eta theta iota".split()) for _ in range(60)] for _ in range(20)]
    docs = [(i, " ".join(w if r.random() > 0.01 else "new" for w in base[i % 20])) for i in range(300)] + EDGES
    rows = simhash.near_duplicates(frame(spark, docs)).collect()
    prints = sorted({x["fp"] for x in rows})
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2:
                parent[root(a)] = root(b)
    least = {}
    for x in rows:
        if x["doc_id"] is not None:
            least[root(x["fp"])] = min(least.get(root(x["fp"]), 1 << 60), x["doc_id"])
    assert len(rows) == len(docs) and all(x["component_id"] == least.get(root(x["fp"])) for x in rows)
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def brute_classes(docs, size=5, similarity=0.8):
    """Index of a class for each document, by all pairs."""
    def shingles(text):
        words = re.findall("[^\\x20\\x09-\\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        return {" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()

    sets, at = [shingles(t) for _, t in docs], list(range(len(docs)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if at[i] != at[j] and (a == b or len(a & b) >= similarity * len(a | b)):
                at = [at[j] if x == at[i] else x for x in at]
    return at


def edited(r, words, share):
    return " ".join(w if r.random() > share else f"new{r.randint(0, 999)}" for w in words)


@pytest.mark.parametrize("nodes", [(4096, 4096), (128, 9), (7, 3)])
def test_near_copies(monkeypatch, spark, nodes):
    """Every class at 0.8 exactly as all pairs give it, and the smallest id kept; small trees split groups and shards."""
    monkeypatch.setattr(near_copies, "SHARD_NODES", nodes[0])
    monkeypatch.setattr(near_copies, "TREE_NODES", nodes[1])
    r = random.Random(6)
    base = [[f"w{r.randint(0, 3000)}" for _ in range(r.choice((60, 150, 400)))] for _ in range(25)]
    docs = [(i, edited(r, base[i % 25] if i % 3 else base[0], r.choice((0, 0.005, 0.01, 0.02, 0.05)))) for i in range(300)] + EDGES + [(905, "Twin TEXT"), (906, "x y z w v u")]
    least = {}
    for (d, t), c in zip(docs, brute_classes(docs), strict=True):
        least[c] = min(least.get(c, (2**60, "")), (-1 if d is None else d, t or ""))
    got = near_copies.keep_one(frame(spark, docs)).collect()
    assert sorted(-1 if x["doc_id"] is None else x["doc_id"] for x in got) == sorted(d for d, _ in least.values())
    assert set(got[0].asDict()) == {"doc_id", "text", "shard"}
    assert near_copies.keep_one(frame(spark, [])).count() == 0


def test_class_tree():
    """Links connect what all pairs connect, though whole subtrees are skipped."""
    r = random.Random(7)
    items = [(r.getrandbits(12), k) for k in range(400)]
    near = lambda a, b: (a[0] ^ b[0]).bit_count() <= 2 and (a[1] + b[1]) % 3 > 0

    def joined(pairs):
        at = list(range(len(items)))
        for a, b in pairs:
            if at[a] != at[b]:
                at = [at[a] if x == at[b] else x for x in at]
        return [at.index(x) for x in at]

    links = [(a[1], b[1]) for a, b in near_copies.class_links(items[:300], iter(items[300:]), 2, near)]
    want = [(a[1], b[1]) for i, a in enumerate(items) for b in items[:i] if near(a, b) and b[1] < 300]
    assert joined(links) == joined(want) and len(links) < len(items) * 2


def test_bk_tree_and_split_shards(monkeypatch, spark):
    monkeypatch.setattr(simhash, "TREE_NODES", 3)
    r = random.Random(2)
    xs = [r.getrandbits(64) & 0xFFFF for _ in range(60)]
    tree = simhash.BKTree()
    for x in xs:
        tree.add(x)
    assert all(sorted(tree.near(x, 3)) == sorted({y for y in xs if (x ^ y).bit_count() <= 3}) for x in xs)
    signed = sorted({x for x in xs})
    got = {frozenset((u, v)) for u, v in map(tuple, simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), 2).collect())}
    label = {x: x for x in signed}
    for _ in range(len(signed)):
        for a, b in map(tuple, got):
            label[a] = label[b] = min(label[a], label[b])
    for a in signed:
        for b in signed:
            if (a ^ b).bit_count() <= 2:
                assert label[a] == label[b]


def by_shard(rows):
    by = {}
    for x in rows:
        by.setdefault(x["shard"], []).append(x)
    assert all(sorted(x["slot"] for x in g) == list(range(len(g))) for g in by.values())
    return by


def test_histogram_shards(spark):
    r = random.Random(3)
    docs = [(i, f"{i % 900} " + "w" * (i % 900 % 401)) for i in range(9000)] + [e for e in EDGES if len(e[1] or "") < 1000]
    rows = histogram_shards.shard_documents(frame(spark, docs).withColumns({"_k1": F.lit(1), "part": F.lit(2)}), shards=8, tolerance=0.05).collect()
    by, mean = by_shard(rows), sum(x["size"] for x in rows) / 8
    assert len(rows) == len(docs) and set(by) == set(range(8)) and all(x["_k1"] == 1 and x["part"] == 2 for x in rows)
    # A text's ten copies are fewer bytes than the tolerance, so no cut parts them.
    assert 10 * (16 + 405) < 0.05 * mean and all(abs(sum(x["size"] for x in g) - mean) <= 2 * 0.05 * mean for g in by.values())
    where = {}
    for x in rows:
        where.setdefault(x["text"], set()).add(x["shard"])
    assert all(len(s) == 1 for s in where.values())


def test_histogram_shards_cut_a_group_that_is_too_large(spark):
    r = random.Random(3)
    docs = [(i, "w" * r.randint(0, 400)) for i in range(3000)] + [(5000 + i, "same text " * 9) for i in range(9000)] + EDGES[:1]
    rows = histogram_shards.shard_documents(frame(spark, docs), shards=8).collect()
    by, mean = by_shard(rows), sum(x["size"] for x in rows) / 8
    assert set(by) == set(range(8)) and all(abs(sum(x["size"] for x in g) - mean) <= 2 * histogram_shards.TOLERANCE * mean + 2 * 416 for g in by.values())
    parted = {x["shard"] for x in rows if x["doc_id"] >= 5000}
    assert len(parted) >= 6 and parted == set(range(min(parted), max(parted) + 1))
    assert len(histogram_shards.shard_documents(frame(spark, docs + EDGES), shards=8).collect()) == len(docs) + len(EDGES)
    assert histogram_shards.shard_documents(frame(spark, [])).count() == 0


@pytest.mark.parametrize("n", [40, 5000])
def test_splitters_of_many_parts(monkeypatch, n):
    """Cuts within tolerance, by keys counted in memory; thousands of parts take seconds."""
    import numpy as np

    rng = np.random.default_rng(1)
    k1 = rng.integers(-(1 << 63), (1 << 63) - 1, 400_000)
    k1[:100_000] = 7  # a text that holds a quarter of all rows
    k2, size = rng.integers(-(1 << 63), (1 << 63) - 1, len(k1)), rng.integers(16, 300, len(k1))
    order = np.lexsort((k2, k1))
    k1, k2, size = k1[order], k2[order], size[order]
    run = np.concatenate(([0], np.cumsum(size)))

    def below(keys, p1, p2):
        a, b = np.searchsorted(k1, p1, "left"), np.searchsorted(k1, p1, "right")
        at = np.array([x + np.searchsorted(k2[x:y], z) for x, y, z in zip(a, b, p2, strict=True)])
        return np.column_stack((run[at], at))

    class Keys:
        def agg(self, *columns):
            return self

        def first(self):
            return int(run[-1]), len(k1)

    monkeypatch.setattr(histogram_shards, "below", below)
    monkeypatch.setattr(histogram_shards.F, "sum", lambda *a: None)
    monkeypatch.setattr(histogram_shards.F, "coalesce", lambda *a: None)
    monkeypatch.setattr(histogram_shards.F, "lit", lambda *a: None)
    monkeypatch.setattr(histogram_shards.F, "count", lambda *a: None)
    cuts, under = histogram_shards.splitters(Keys(), n)
    off = np.abs(under[:, 0] - run[-1] * np.arange(1, n) / n)
    assert off.max() <= max(histogram_shards.TOLERANCE * run[-1] / n, 300)
    assert (np.diff(under[:, 1]) >= 0).all() and len(cuts) == n - 1


def test_personal_data(spark):
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def luhn(d):
        return sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d[::-1])) % 10 == 0

    def good(k, s):
        d = [int(c) for c in s if c.isdigit()]
        return {"email": True, "ip": all(int(p) < 256 for p in s.split(".")) if k == "ip" else True, "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[k]

    r = random.Random(4)
    texts = ["".join(r.choice("ab.@-_+%19 0().\né𝄞,") for _ in range(r.randint(0, 60))) for _ in range(2000)]
    texts += ["4111 1111-1111 1111", "1.2.3.4.5.6.7.8 a@b.c_d@e.f", "1 " * 30_000, "a." * 20_000 + "@" + "b." * 20_000 + "c", "a@b.c@d.e", "DE89 3704 0044 0532 0130 00", "DE88 3704 0044 0532 0130 00", None, ""]
    rows = {x["doc_id"]: x for x in personal_data.find_personal_data(frame(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        want = [(k, *m.span()) for k, p in kinds.items() for m in re.finditer(p, t or "") if good(k, m[0])]
        assert [(x["kind"], x["start"], x["end"]) for x in rows[i]["personal_data"] if x["kind"] in kinds] == want
    iban = [[x["kind"] for x in rows[len(texts) - k]["personal_data"] if x["kind"] == "iban"] for k in (4, 3)]
    assert iban == [["iban"], []]
    clean = personal_data.redact(frame(spark, [(1, "mail a@b.co now, card 4111111111111111!"), (2, None)])).orderBy("doc_id").collect()
    assert [x["text"] for x in clean] == ["mail <EMAIL> now, card <CARD>!", None]


def test_personal_data_in_long_texts(spark):
    """Spans of a quarter of a megabyte of each kind, and the text without them, as plain patterns give them."""
    shapes = {"ip": "10.20.30.{}, é ", "email": "ab{}@c.de, 𝄞 ", "card": "card 4111 1111 1111 1111, {}. ", "phone": "+49 30 1234 {}; "}
    plain = {"ip": r"[0-9]+(?:\.[0-9]+){3}", "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "card": r"[0-9](?:[ -]?[0-9]){15,}", "phone": r"\+[0-9][ ().0-9-]+[0-9]"}
    texts = [(k, "".join(shape.format(i % 200) for i in range(256_000 // len(shape)))) for k, shape in shapes.items()]
    df = spark.createDataFrame(texts, "shape string, text string").withColumn("_spans", F.lit(1))
    for x in personal_data.find_personal_data(df).collect():
        want = [m.span() for m in re.finditer(plain[x["shape"]], x["text"])]
        assert x["_spans"] == 1 and [(s["start"], s["end"]) for s in x["personal_data"]] == want and len(want) > 4000
    for x in personal_data.redact(df).collect():
        assert x["text"] == re.sub(plain[x["shape"]], f"<{x['shape'].upper()}>", dict(texts)[x["shape"]])
    many = spark.createDataFrame([("DE89 3704 0044 0532 0130 00 BIC ABC " * 1000,)], "text string")
    assert set(personal_data.redact(many).first()["text"].split(" BIC ABC ")) == {"<IBAN>", ""}
    assert personal_data.redact(frame(spark, [])).count() == personal_data.find_personal_data(frame(spark, [])).count() == 0
    near = spark.createDataFrame([("3782 822463 10005 is my amex",), ("3782 822463 10005 is mine",)], "text string")
    assert [len(x["personal_data"]) for x in personal_data.find_personal_data(near).collect()] == [1, 0]


def test_personal_data_followed_by_more_groups(spark):
    texts = {
        "IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX": ["DE89 3704 0044 0532 0130 00"],
        "DE89370400440532013000 EUR 50": ["DE89370400440532013000"],
        "DE89370400440532013000 I think": ["DE89370400440532013000"],
        "REF AB12 DE89 3704 0044 0532 0130 00 GB29 NWBK 6016 1331 9268 19 OK": ["DE89 3704 0044 0532 0130 00", "GB29 NWBK 6016 1331 9268 19"],
        "DE89370400440532013000x, DE88 3704 0044 0532 0130 00 EUR": [],
        "amex 3782 822463 10005 12 27": ["3782 822463 10005"],
        "amex 378282246310005": ["378282246310005"],
        "amex 3782 822463 10006 12 27, 3782822463100051227": [],
        "card 4111 1111 1111 1111": [],
    }
    rows = personal_data.find_personal_data(frame(spark, list(enumerate(texts)))).collect()
    got = {x["text"]: [x["text"][s["start"] : s["end"]] for s in x["personal_data"] if s["kind"] in ("iban", "short_card")] for x in rows}
    assert got == texts


def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    return public.path("word_bpe_49k.json"), public.path("piece_bpe_32k.model")


def test_token_tables(spark, tmp_path):
    path, _ = tokenizer()
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    docs = [(i, f"Words, of 3.5 documents... don't <|endoftext|> × ÉT {i}!") for i in range(500)] + EDGES
    made = token_tables.write_token_tables(frame(spark, docs), f"file://{tmp_path}/t", path).collect()
    got = token_tables.token_tables(frame(spark, docs), path).collect()
    want = {}
    for d, x in docs:
        want.setdefault(d, []).append([*t.encode(x or "", add_special_tokens=False).ids, 1])
    assert sorted((x["doc_id"] or -1, list(x["ids"])) for x in got) == sorted((d or -1, i) for d, v in want.items() for i in v)
    ordered, start = sorted(got, key=lambda x: x["start"]), 0
    for x in ordered:
        assert x["start"] == start and x["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in x["ids"]))
        start += x["n_tokens"]
    found = [token_tables.Table(m["path"]) for m in made]
    for d in (0, 123, 499, 904, None):
        assert [list(v) for f in found for v in f.get(d)] == want[d]
    assert not any(f.get(77_777) for f in found)
    assert token_tables.token_tables(frame(spark, []), path).count() == 0


def test_token_tables_of_other_tokenizers():
    """A tokenizer whose words aren't parted by blanks is asked for whole texts."""
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("byte_bpe_50k.json")
    t, texts = Tokenizer.from_file(path), ["Two  words, É!\n x", "", " <|endoftext|> 3.5..."]
    assert [x.tolist() for x in token_tables.Encoder(path).ids([x.encode() for x in texts])] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_unigram_scores_of_its_own(tmp_path):
    """A Unigram model's scores are its own; the public file is made one by its type alone."""
    _, path = tokenizer()
    data = open(path, "rb").read()
    assert not unigram.is_unigram(data)
    trainer = next(v for k, v in unigram.fields(data) if k == unigram.TRAINER)
    kind = bytes([unigram.MODEL_TYPE << 3, 2])
    assert trainer.count(kind) == 1 and data.count(trainer) == 1
    (tmp_path / "u.model").write_bytes(data.replace(trainer, trainer.replace(kind, bytes([unigram.MODEL_TYPE << 3, 1]))))
    own, zipf = unigram.Vocabulary.load(str(tmp_path / "u.model")), unigram.Vocabulary.load(path)
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=str(tmp_path / "u.model"))
    assert all(a == library.get_score(i) for i, (a, ok) in enumerate(zip(own.scores, own.normal, strict=True)) if ok)
    assert own.pieces == zipf.pieces and own.scores != zipf.scores
    assert unigram.Vocabulary.load(str(tmp_path / "u.model"), "zipf").scores == zipf.scores
    model = unigram.Unigram(own)
    score = lambda ids: sum(own.scores[i] if own.normal[i] else 0 for i in ids)
    for t in ("hello there world", "The quick brown fox", "été à la plage"):
        # The library's single-precision sums may lose a little where one piece scores -1e9.
        assert score(model.encode(t).tolist()) >= score(library.encode(t)) - 1e-6


def test_radix_order():
    import numpy as np

    rng = np.random.default_rng(3)
    for n, top in ((0, 1), (1, 1), (5000, 3), (100_000, 90_000)):
        group, digit = rng.integers(0, top, n), rng.integers(0, 1 << 63, n, np.uint64) >> rng.integers(0, 63, n).astype(np.uint64)
        assert (suffix_dedup.radix_order(group, digit) == np.lexsort((digit, group))).all()


def test_columns_pass_whatever_their_names(spark):
    """Names that operators use inside stay the caller's own; empty tables stay empty."""
    _, path = tokenizer()
    names = ["_encoded", "encoded", "row", "_k1", "part", "n", "first", "_key", "key", "_spans", "_id", "hash", "bad_id", "window", "at", "n_words"]
    df = frame(spark, [*EDGES, (1, "a b c d e f")]).withColumns({c: F.lit(i) for i, c in enumerate(names)})
    benchmark = spark.createDataFrame([(1, "one item of some more words")], "item_id long, text string")
    runs = {
        "unigram": lambda d: unigram.encode_documents(d, path), "shards": lambda d: histogram_shards.shard_documents(d, 2), "pii": personal_data.find_personal_data, "redact": personal_data.redact,
        "near": near_copies.keep_one, "leaks": lambda d: decontamination.decontaminate(d, benchmark), "quality": lambda d: compression_quality.score(d, compression_quality.Model(b" " * 8, b" " * 8)),
    }
    for name, run in runs.items():
        rows = run(df).collect()
        assert rows and all(x[c] == i for x in rows for i, c in enumerate(names)), name
        assert run(df.limit(0)).count() == 0, name


def test_unigram(spark):
    _, path = tokenizer()
    v = unigram.Vocabulary.load(path)
    model = unigram.Unigram(v)
    score = {p: s for p, s, ok in zip(v.pieces, v.scores, v.normal, strict=True) if ok}

    def brute(text):
        best = {0: 0.0}
        for end in range(1, len(text) + 1):
            for at in range(end):
                s = score.get(text[at:end].encode(), model.lowest if end - at == 1 else None)
                if s is not None and at in best:
                    best[end] = max(best.get(end, -1e18), best[at] + s)
        return best[len(text)]

    for t in ["a", "hello there  world", "\n\n x\n", "日本 𝄞x ßé", "x\r\ny\tz", "▁a", "a\0b"]:
        ids = model.encode(t).tolist()
        got, k = 0.0, 0
        while k < len(ids):
            if model.is_byte[ids[k]]:
                lead = v.pieces[ids[k]][0]
                k += 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                got += model.lowest
            else:
                got += v.scores[ids[k]]
                k += 1
        assert abs(got - brute(unigram.MARK + t.replace(" ", unigram.MARK))) < 1e-6
        assert model.decode(ids) == t.replace("▁", " ")
    out = unigram.encode_documents(frame(spark, EDGES), path).collect()
    assert all(x["decoded"] == (x["text"] or "") for x in out) and len(out) == len(EDGES)


def test_line_rules(spark):
    prose = " ".join(f"word{i} and{i} some{i} more{i} of{i} it," for i in range(12))
    r = line_rules.clean(f"{prose}\nhome | about | contact | login\n{prose}\n")
    assert r["rules"] == "navigation,repeat" and r["n_dup_lines"] == 1 and r["base_failed"] and r["n_repeat_words"] == 144
    assert line_rules.clean(prose)["kept"] and not line_rules.clean("")["kept"]
    words, seen = "a b c a b c d".split(), {}
    assert line_rules.clean(" ".join(words))["n_repeat_words"] == 6
    assert line_rules.clean_documents(frame(spark, EDGES)).count() == len(EDGES)


def noise(r, words, n):
    return "".join(r.choice((*words, " ", " ", "\n", "\t", ".", "|", "#", "é", "\x1c", "\u00a0", "\u2003", "𝄞")) + r.choice(("", " ")) for _ in range(n))


def test_line_rules_base_by_brute_force():
    r = random.Random(12)
    texts = [noise(r, ("a", "b", "Word", "c d"), r.randint(0, 120)) for _ in range(1500)] + ["", "\n\n", "a b c a b c", "x\n\nx\n \n \nx"]
    for t in texts:
        words = re.findall("[^\\x20\\x09-\\x0D]+", t)
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        inside = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in (i, i + 1, i + 2)}
        lines = t.split("\n")
        copies = sum(1 for i, line in enumerate(lines) if re.search("[^\\x20\\x09-\\x0D]", line) and line in lines[:i])
        got = line_rules.clean(t)
        assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"], got["n_repeat_words"]) == (len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), copies, len(inside))
        assert got["base_failed"] == (len(words) < 50 or 2 * len(inside) > len(words)) and not (got["base_failed"] and got["kept"])


def test_line_rules_in_four_languages(spark):
    prose = " ".join(f"word{i} and{i} some{i} more{i} of{i} it," for i in range(12))
    for line, rule in (("Inicio Contacto Ayuda", "navigation"), ("Accueil » Aide", "navigation"), ("Impressum Datenschutz", "navigation"), ("Tous droits réservés 2020 par nous tous", "boilerplate"), ("Alle Rechte vorbehalten, wir alle hier", "boilerplate"), ("Política de privacidad de esta casa nuestra", "boilerplate")):
        assert line_rules.clean(f"{prose}\n{line}\n")["rules"] == rule
    assert line_rules.clean(f"{prose}\nRed shoes\nBlue shoes\n\nGreen hats\nOld hats\n{prose} x")["cleaned"] == f"{prose}\n\n{prose} x"
    assert line_rules.clean(f"Some heading\n{prose}\nOne more\n{prose} x")["rules"] == ""
    assert line_rules.clean_documents(frame(spark, [])).count() == 0


def test_license_phrases_by_brute_force():
    r = random.Random(13)
    automata = {k: license_templates.compile_template(t) for k, t in license_templates.TEMPLATES.items()}
    texts = [noise(r, ("cc by", "CC", "by", "General Public", "license", "all rights", "reserved", "all rights reserved", "general public license"), r.randint(0, 60)) for _ in range(800)]
    for t in [*texts, "", "cc by" * 3, "cc by " * 5000]:
        words = re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        found = [(i, label) for phrase, label in license_templates.PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        got, at = license_templates.scan(t.encode(), automata), [i for i, _ in found]
        assert got[:5] == (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found})))
    began = time.time()
    assert license_templates.scan(b"cc by " * 200_000, automata)[1] == 200_000 and time.time() - began < 20


def test_whole_licenses_and_parts_of_them(spark):
    """Optional regions may be missing and replaceable ones filled; mandatory wording may not change."""
    def fill(t):
        t = re.sub("<<beginOptional>>.*?<<endOptional>>", "", t)
        t = re.sub("<<var;max=[0-9]+>>", "x y", t)
        return re.sub("<<var;match=([^|>]+)[^>]*>>", lambda m: m[1], t)

    filled = {k: fill(t) for k, t in license_templates.TEMPLATES.items()}
    automata = {k: license_templates.compile_template(t) for k, t in license_templates.TEMPLATES.items()}
    labels = lambda t: set(license_templates.scan(t.encode(), automata)[5].split(","))
    whole = [k for k in license_templates.TEMPLATES if not k.endswith(("-notice", "-header"))]
    assert {"mit", "bsd-2-clause", "bsd-3-clause", "isc", "zlib", "unlicense"} == set(whole)
    for k in whole:
        assert k in labels("Some Title\n" + filled[k].upper() + ". More"), k
        words = filled[k].split()
        for i in (len(words) // 3, len(words) - 2):
            assert k not in labels(" ".join([*words[:i], "must give me your house", *words[i + 1 :]])), k
        assert k not in labels(" ".join(words[: len(words) * 2 // 3]))
    assert "bsd-2-clause" not in labels(filled["bsd-3-clause"]) and "bsd-3-clause" not in labels(filled["bsd-2-clause"])
    assert "agpl-header" not in labels(filled["gpl-header"]) and "gpl-header" not in labels(filled["lgpl-header"])
    assert license_templates.scan_licenses(frame(spark, [])).count() == 0


def test_license_templates(spark):
    a = license_templates.compile_template("licensed under <<beginOptional>> the <<endOptional>> foo license <<var;match=1|2>> by <<var;max=2>> end")
    for t, ok in (("licensed under foo license 1 by end", True), ("x licensed under the foo license 2 by a b end", True), ("licensed under foo license 3 by end", False), ("licensed under foo license 1 by a b c end", False), ("licensed under the the foo license 1 by end", False)):
        w = t.encode().split()
        assert bool(a.find(w, b" " + b" ".join(w) + b" ")) == ok
    for bad in ("<<beginOptional>> a", "<<var;max=2>>", "a <<what>>"):
        with pytest.raises(ValueError):
            license_templates.compile_template(bad)
    rows = {x["doc_id"]: x for x in license_templates.scan_licenses(frame(spark, [*EDGES, (1, "CC-BY cc by. Licensed under the GNU General Public License, version 3.")])).collect()}
    assert (rows[1]["n_base"], rows[1]["first_word"], rows[1]["last_word"], rows[1]["labels"]) == (3, 0, 8, "cc-by,gpl,gpl-notice") and rows[900]["n_words"] == 0


def test_decontamination(spark):
    items = spark.createDataFrame([(1, "Tom had 12 apples and gave 5 to Anna, so how many apples does Tom have left of the 12 now ok"), (2, None), (3, "short one")], "item_id long, text string")
    docs = frame(spark, [*EDGES, (1, "x y. Zed had 30 apples and gave 7 to Mary, so how many apples does Zed have left of the 30 now ok yes"), (2, "Zed had 30 apples and gave 7 to Mary, so how many apples does Zed have left of the 31 now ok yes"), (3, "a short one here")])
    got = {(x["doc_id"], x["item_id"]) for x in decontamination.leaks(docs, items).collect()}
    assert got == {(1, 1)}
    assert [x["item_id"] for x in decontamination.too_short(items).orderBy("item_id").collect()] == [2, 3]
    kept = decontamination.decontaminate(docs.withColumns({"_id": F.lit(1), "hash": F.lit(2)}), items)
    assert kept.count() == len(EDGES) + 2 and kept.columns == ["doc_id", "text", "shard", "_id", "hash"]
    none = items.limit(0)
    assert decontamination.decontaminate(docs, none).count() == len(EDGES) + 3 and decontamination.leaks(docs.limit(0), items).count() == 0


def test_decontamination_slots(spark):
    """The item's values determine the document's, over all that counts; too little wording matches nothing."""
    asked = "What is the sum of {} and {} if we add them all up twice?"
    split = "Tom had {} apples and put all of them into the old basket. Then he gave {} of the apples to Anna and kept the others; at last {} apples were left in there"
    items = spark.createDataFrame([(1, asked.format(3, 5)), (2, asked.format(3, 3)), (3, "Why?"), (4, "12 30 5"), (5, split.format(12, 5, 12))], "item_id long, text string")
    docs = [(1, asked.format(4, 4)), (2, asked.format(7, 9)), (3, asked.format("seven", 9)), (4, "Why? " + "12 30 5 " * 4), (5, split.format(20, 5, 20)), (6, split.format(20, 5, 30)), (7, split.format(20, 5, 30).replace("basket.", "basket, as one does now and then."))]
    rows = {(x["doc_id"], x["item_id"]): x["coverage"] for x in decontamination.leaks(frame(spark, docs), items).collect()}
    assert set(rows) == {(1, 1), (1, 2), (2, 1), (3, 1), (5, 5)}


@pytest.mark.parametrize("limit", [0, 10])
def test_decontamination_by_exchange(monkeypatch, spark, limit):
    """A benchmark or a list of leaks too large to broadcast gives the same."""
    r = random.Random(11)
    items = [(i, " ".join(f"w{r.randint(0, 40)}" for _ in range(r.randint(6, 20)))) for i in range(30)]
    docs = [(i, " ".join(f"w{r.randint(0, 40)}" for _ in range(5)) + f" {items[i % 30][1]} " + r.choice(("x", "y z"))) for i in range(90)] + EDGES
    df, benchmark = frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    want = sorted(map(tuple, decontamination.leaks(df, benchmark).collect()))
    kept = decontamination.decontaminate(df, benchmark).count()
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", limit)
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", limit)
    assert sorted(map(tuple, decontamination.leaks(df, benchmark).collect())) == want and len(want) >= 85
    assert decontamination.decontaminate(df, benchmark).count() == kept == len(EDGES) + 90 - len({w[0] for w in want})


def test_decontamination_in_other_case_and_lines(spark):
    text = "La doesbo dora el es, queasar mente, cion asesrr nos ueos ueie, oses gaiedo, esci llar osn que and gave 5 km to Anna, so how many"
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    docs = [(1, text.upper()), (2, text.lower()), (3, text.title()), (4, text.replace(" ", "\n")), (5, text.upper().replace("5", "7")), (6, text.replace(" ", " \u00a0\r\n").replace("Anna", "Mary").replace("5", "7")), (7, text.upper()[:40])]
    rows = {x["doc_id"]: x for x in decontamination.leaks(frame(spark, docs), items).collect()}
    assert {k: x["same_values"] for k, x in rows.items()} == {1: True, 2: True, 3: True, 4: True, 5: False, 6: False}
    assert all(x["coverage"] == 1 for x in rows.values())


def test_decontamination_of_names_that_open_sentences(spark):
    text = "Tom had 12 apples and put all of them into the basket. Anna gave 7 of her own apples to the boy and then took the rest of them home"
    items = spark.createDataFrame([(1, text), (2, "Anna saw 9 of the red birds fly by"), (3, "Anna saw 9 birds high up there"), (4, "What is it about these days?")], "item_id long, text string")
    docs = [(1, text.replace("Anna", "Mary")), (2, "It rained. Omar saw 8 of the red birds fly by"), (3, "It rained. Omar saw 8 birds high up there"), (4, "That is it about these days."), (5, text.replace("Anna", "Mary").replace("12", "7").replace("home", "home again 12").replace("7 apples", "12 apples", 1)), (6, text.replace("Anna", "Mary").replace("7", "12"))]
    got = {(x["doc_id"], x["item_id"]) for x in decontamination.leaks(frame(spark, docs), items).collect()}
    assert got == {(1, 1), (2, 2), (3, 3), (5, 1), (6, 1)}


def brute_leaks(docs, items, window=8, coverage=0.8):
    """Pairs (document's place, item) by comparing every window with every window in each form."""
    import regex

    d = decontamination
    slot = (d.NUMBER, d.NAME, d.UNIT)

    def parse(text):
        w = regex.sub(r"[^\p{L}\p{N}]+", " ", text).lower().split()
        t = regex.sub(r"\s+", " ", text)
        t = regex.sub(r"(?<![\p{L}\p{N}])[0-9]+(?![\p{L}\p{N}])", d.NUMBER, t)
        t = regex.sub(r"(?<=[\p{Ll},] )\p{Lu}\p{L}*+(?![\p{N}])", d.NAME, t)
        t = regex.sub(r"((?:^|[.?]) ?)\p{Lu}\p{L}*+(?![\p{N}])", r"\1" + d.OPEN, t)
        t = regex.sub(rf"[^\p{{L}}\p{{N}}{d.NUMBER}{d.NAME}{d.UNIT}{d.OPEN}]+", " ", t).lower().split()
        number = [x == d.NUMBER or x in d.NUMBERS for x in t]
        t = [d.NUMBER if n else d.UNIT if x in d.UNITS and i and number[i - 1] else x for i, (x, n) in enumerate(zip(t, number, strict=True))]
        return w, t

    def formed(kind, w, t):
        if kind == d.PLAIN:
            return w
        words = {d.COUNTED: (d.OPEN, d.NAME), d.NAMED: (d.OPEN,), d.OPENED: ()}[kind]
        return [a if b in words else d.NAME if b == d.OPEN else b for a, b in zip(w, t, strict=True)]

    out = set()
    parsed = [parse(body or "") for _, body in docs]
    for item, text in items:
        iw, it = parse(text or "")
        if sum(x not in (*slot, d.OPEN) for x in it) < d.LITERALS:
            continue
        size = min(window, len(it))
        n = len(it) - size + 1
        views = [(k, formed(k, iw, it), n) for k in d.KINDS]
        if regex.match(r" *\p{Lu}\p{L}*+(?![\p{N}])", text or ""):
            views.append((d.NAMED, formed(d.NAMED, iw, [d.NAME, *it[1:]]), 1))
        for k, (dw, dt) in enumerate(parsed):
            found = {}
            for kind, head, many in views:
                body = formed(kind, dw, dt)
                for i in range(many):
                    for j in range(len(dt) - size + 1):
                        if head[i : i + size] != body[j : j + size]:
                            continue
                        slots = {(t, a, b) for t, a, b in zip(head[i : i + size], iw[i : i + size], dw[j : j + size], strict=True) if t in slot}
                        if i == 0 and kind != d.OPENED and head[0] == d.NAME and iw[0] != dw[j]:
                            continue
                        if kind == d.OPENED and (sum(t in slot for t in head[i : i + size]) == size or any(t == d.NAME and a != b and (a in d.OPENERS or b in d.OPENERS) for t, a, b in slots)):
                            continue
                        at, held = found.setdefault((j - i, kind), (set(), set()))
                        at.add(i)
                        held |= slots
            good = sorted((-len(at), offset, kind, at, slots) for (offset, kind), (at, slots) in found.items() if len(slots) == len({x[:2] for x in slots}))
            given = {}
            for *_, slots in good:
                for t, a, b in slots:
                    given.setdefault((t, a), b)
            counted = [at for *_, at, slots in good if all(given[t, a] == b for t, a, b in slots)]
            if counted and len(set.union(*counted)) >= coverage * n:
                out.add((k, item))
    return out


def test_decontamination_by_brute_force(spark):
    r = random.Random(8)
    said = "the a of to gives takes more than left how many are there each so then".split()
    names, units = "Tom Anna Zed Mary Omar".split(), "km kg hours miles".split()

    def sentence(n):
        out = [r.choice((*said, *said, str(r.randint(1, 40)) + " " + r.choice(units), r.choice(names), "seven", "dos km")) for _ in range(n)]
        return " ".join([out[0].capitalize(), *out[1:]]) + r.choice((".", "?", ""))

    items = [(i, sentence(r.randint(3, 15)) + " " + sentence(r.randint(1, 15))) for i in range(25)] + [(90, None), (91, ""), (92, "What is it?")]
    docs = []
    for i in range(150):
        text = items[r.randrange(25)][1]
        if r.random() < 0.5:
            text = re.sub("[0-9]+", lambda m: str((int(m[0]) * 7) % r.choice((41, 5))), text)
        if r.random() < 0.3:
            text = text.replace("Tom", "Lea").replace(r.choice(names), "Tom")
        if r.random() < 0.3:
            text = text[: r.randint(1, len(text))]
        if r.random() < 0.3:
            text = f"{text} {sentence(3)} {text}"
        docs.append((i, f"{sentence(r.randint(2, 9))} {text} {sentence(r.randint(2, 9))}"))
    docs += [(150, "so what is it now"), (151, "so What is it"), (152, None), (153, "")]
    got = {(x["doc_id"], x["item_id"]) for x in decontamination.leaks(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = brute_leaks(docs, items)
    assert got == want and len(want) > 60


def test_quality_edges(spark):
    """Whatever the labels, every score is from 0 to 1; without both kinds all are 0.5."""
    r = random.Random(9)
    prose = "the of and a river house walked through morning light with her small brown dog along old stone wall".split()
    docs = [(i, " ".join(r.choice(prose) for _ in range(80)) if i % 2 else "buy $$$ now!!! " * 30 + str(r.random())) for i in range(200)] + EDGES
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int")
    nothing = [[], [(i, 1) for i in range(200)], [(i, i % 2) for i in range(5000, 5100)], [(900, 0), (901, 1)], [(None, 1), (3, None), (1, 1), (2, 7)]]
    for rows in nothing:
        model = compression_quality.fit(frame(spark, docs), labels(rows))
        assert {x["quality_score"] for x in compression_quality.score(frame(spark, EDGES), model).collect()} == {0.5}
    taught = [(i, i % 2) for i in range(200)] + [(i, i % 2) for i in range(60)] + [(900, 1), (902, 0), (903, 0), (None, 1)]
    model = compression_quality.fit(frame(spark, docs), labels(taught))
    scored = compression_quality.score(frame(spark, docs).withColumn("quality_score", F.lit("x")), model).collect()
    assert len(scored) == len(docs) and all(0 <= x["quality_score"] <= 1 and x["shard"] == "clash" for x in scored)
    good = [x["quality_score"] > 0.5 for x in scored if x["doc_id"] is not None and x["doc_id"] < 200 and x["doc_id"] % 2]
    bad = [x["quality_score"] < 0.5 for x in scored if x["doc_id"] is not None and x["doc_id"] < 200 and x["doc_id"] % 2 == 0]
    assert all(good) and all(bad)
    assert compression_quality.score(frame(spark, []), model).count() == 0
    text = bytes(range(256)) * 40
    assert compression_quality.blocks(text) == [text[a * 1024 : a * 1024 + 1024] for a in (0, 2, 5, 7)] and compression_quality.blocks(b"") == []


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no tables")
def test_quality_on_held_out_labels(spark):
    from sokhan.llm.compression_quality import op8_compression_quality

    sf = TABLES.replace("0.001", "0.01")
    labels = {x["doc_id"]: x["quality"] for x in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op8_compression_quality(spark, sf).collect()
    held = [(x["predicted"], labels[x["doc_id"]]) for x in rows if x["held_out"] and x["doc_id"] in labels]
    assert all(0 <= x["score"] <= 1 for x in rows) and sum(a == b for a, b in held) >= 0.93 * len(held) > 30


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no tables")
def test_pipeline_on_tables(spark):
    import corpus_pipeline as p

    rows = p.run(spark, TABLES).collect()
    assert rows and all(x["round_trip"] for x in rows)
    texts = [x["text"] for x in spark.read.parquet(f"{TABLES}/benchmark.parquet").collect()]
    assert not any(t in x["text"] for x in rows for t in texts)
    assert len({hashlib.sha256(x["text"].encode()).hexdigest() for x in rows}) == len(rows)


def test_pipeline_edges(spark, tmp_path):
    """Nulls, empty, long and repeated rows, other columns, and an empty table."""
    import corpus_pipeline as p

    r = random.Random(14)
    prose = "the of and a river house walked through morning light with her small brown dog along old stone wall".split()
    good = [(i, " ".join(r.choice(prose) for _ in range(90))) for i in range(60)]
    bad = [(100 + i, "buy $$$ now!!! " * 30 + str(r.random())) for i in range(60)]
    asked = "how many stone walls did the old brown dog walk through in the morning light"
    docs = [*good, *bad, *EDGES, (200, good[0][1]), (201, f"{good[1][1]} {asked} {good[2][1]}"), (202, f"{good[3][1]} mail me: a@b.co {good[4][1]}")]
    wide = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long"), "_id": F.lit(5)})

    def run(sf, rows):
        rows.write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([(i, 1 if i < 100 else 0) for i, _ in good + bad], "doc_id long, quality int").write.parquet(f"{sf}/labels.parquet")
        spark.createDataFrame([(1, asked), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
        return p.run(spark, sf).collect()

    rows = {x["doc_id"]: x for x in run(str(tmp_path / "a"), wide)}
    assert set(range(60)) <= set(rows) and not {100 + i for i in range(60)} & set(rows) and not {200, 201} & set(rows)
    assert "<EMAIL>" in rows[202]["text"] and rows[202]["n_chars"] == len(rows[202]["text"]) and all(x["round_trip"] and x["_id"] == 5 for x in rows.values())
    assert len({901, 902} & set(rows)) == 0  # texts without words are one class, named by 900 if their score stays
    assert run(str(tmp_path / "b"), wide.limit(0)) == []
