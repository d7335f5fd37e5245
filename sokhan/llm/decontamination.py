"""Benchmark decontamination by template windows and slot consistency.

DataFrame functions only. A text becomes words (runs of letters and digits, in
lower case) and a template of as many places, in which numbers (digits, or number
words of four languages but for those that mean one), names (capitalised words after a
lower-case word or a comma) and units (after a number) are placeholders of their type.
Windows of ``WINDOW`` words of documents and benchmark items are hash-joined in each of
four forms: the plain words, with numbers and units as placeholders, with names too, and
with words that open a sentence as names too (two different ones only if neither is of
``OPENERS``), so that a text in other letter case or with another name there is found
as well. Matches of a document and an item in one form on one diagonal (equal offset)
are one alignment.

Slots are consistent if the item's values determine the document's: "3 and 5" may be
asked again as "4 and 4" or "seven and 9", but a value that occurs twice in the item has
one counterpart. An alignment that contradicts itself doesn't count. Of the others those
with more windows come first (then the smaller offset and form); each item value
has the counterpart that the first of them gives it, and only alignments that agree with
all counterparts count. A pair is a leak if these cover ``COVERAGE`` of the item's
windows. A capitalised first word of an item is met as a word and, after another word,
as a name, but only by the same word.

Items shorter than a window are one window of all their words, met by windows of
that length. Items of fewer than ``LITERALS`` words besides placeholders say too little to
be recognised ("Why?", "12 30 5"): they match nothing, and ``too_short`` lists them. Null
and empty texts have no windows. Rows are told apart by id and text: rows with both equal
give one row of result. Null ids are kept as an id of their own. Empty tables give no
rows. Columns of documents pass through decontaminate, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import pairwise

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sokhan.llm.common import packed, prepare, table, unpacked

WINDOW, COVERAGE, LITERALS = 8, 0.8, 5
#: A benchmark of more windows than this, some 60 MB, is joined by a shuffle.
BROADCAST_WINDOWS = 1_000_000
#: Leaking rows of up to this many, some 30 MB, are removed by a broadcast.
BROADCAST_ROWS = 1_000_000
#: What a window is hashed by: plain words, numbers and units as placeholders, names too, words that open a sentence as names too.
KINDS = PLAIN, COUNTED, NAMED, OPENED = range(4)
NUMBER, NAME, UNIT = "\ue000", "\ue001", "\ue002"
#: A capitalised word that opens a sentence: a word, or in the form OPENED a name.
OPEN = "\ue003"
#: Words that open sentences and are no names, of English, Spanish, French and German.
OPENERS = """a an and are as at be but by can did do does each for from had has have he her here his how i if in is it its many most my no not now of on one or our she
so some than that the their then there these they this those to was we were what when where which who whose why will with would you your
como cual cuando cuanto de del donde el ella en es la las lo los para pero por que quien se si su un una y
au aux ce ces combien comment dans des elle est et il ils je le les mais nous ou par pas pour quand quel quelle qui sur une vous
aber auf das dem den der die ein eine er es für ich im in ist mit nicht oder sie sind und von wann war warum was welche wer wie wir wo zu""".split()
UNITS = "km m cm mm kg g mg lb lbs oz l ml s sec min h hr hrs mph usd eur gbp dollars euros pounds cents percent meters metres kilometers kilometres miles feet inches liters litres grams kilograms hours minutes seconds days weeks months years".split()
#: Number words of English, Spanish, French and German; those that mean one are articles too.
NUMBERS = """zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen
twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million
cero dos tres cuatro cinco seis siete ocho nueve diez doce trece catorce quince veinte treinta cuarenta cincuenta sesenta setenta ochenta noventa cien mil
deux trois quatre cinq sept huit neuf dix onze douze treize quatorze quinze seize vingt trente quarante cinquante soixante cent mille
null zwei drei vier fünf sechs sieben acht neun zehn elf zwölf zwanzig dreißig vierzig fünfzig sechzig siebzig achtzig neunzig hundert tausend""".split()


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    clean = F.translate(text, NUMBER + NAME + UNIT + OPEN, "    ")
    return parts(F.regexp_replace(clean, r"[^\p{L}\p{N}]+", " "))


def template(text: Column) -> Column:
    """As words(), with placeholders in place of numbers, names, units and words that open a sentence."""
    marks = F.array(*map(F.lit, ("", NUMBER, UNIT, NAME, OPEN)))
    return bound(marked(text), lambda ts: F.zip_with(ts, numbered(ts), lambda t, p: F.when(p > 0, F.get(marks, p.cast("int"))).otherwise(t)))


def places(text: Column) -> Column:
    """What each word of template() is: 0 for itself, 1 for a number, 2 for a unit, 3 for a name, 4 where it opens a sentence."""
    return bound(marked(text), numbered)


def bound(value: Column, fn: Callable[[Column], Column]) -> Column:
    """fn(value), bound to a name, since the rules that give value would run once for each use."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def marked(text: Column) -> Column:
    """Words with placeholders for digits, names and words that open a sentence."""
    t = F.translate(text, NUMBER + NAME + UNIT + OPEN, "    ")
    # Patterns look at a character itself before those behind it, which is quicker.
    t = F.regexp_replace(t, r"[\s\p{Z}]{2,}|[\s\p{Z}&&[^ ]]", " ")
    t = F.regexp_replace(t, r"[0-9](?<![\p{L}\p{N}][0-9])[0-9]*+(?![\p{L}\p{N}])", NUMBER)
    t = F.regexp_replace(t, r"\p{Lu}(?<=[\p{Ll},] \p{Lu})\p{L}*+(?![\p{N}])", NAME)
    t = F.regexp_replace(t, r"((?:^|[.!?:…][\"'”’»)\]]{0,2}) ?[\"'“‘«(\[¿¡]{0,2})\p{Lu}\p{L}*+(?![\p{N}])", "$1" + OPEN)
    return parts(F.regexp_replace(t, rf"[^\p{{L}}\p{{N}}{NUMBER}{NAME}{UNIT}{OPEN}]+", " "))


def numbered(t: Column) -> Column:
    """The places of marked words: number words are numbers, and units after a number units."""

    def one(w: Column, before: Column) -> Column:
        word = F.when(w.isin(NUMBERS), 1).when(w.isin(UNITS) & ((before == NUMBER) | before.isin(NUMBERS)), 2).otherwise(0)
        return F.when(F.length(w) > 1, word).when(w == NUMBER, 1).when(w == NAME, 3).when(w == OPEN, 4).otherwise(word).cast("long")

    shifted = F.concat(F.array(F.lit("")), F.slice(t, F.lit(1), F.greatest(F.size(t) - 1, F.lit(0))))
    return F.when(F.size(t) > 0, F.zip_with(t, shifted, one)).otherwise(F.array().cast("array<bigint>"))


def parts(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.trim(text)), " "), "")


def at(column: str, i: int) -> Column:
    return F.get(column, F.col("at") + i)


def form(kind: int, w: Column, t: Column) -> Column:
    """A word in one form, by itself and its place in the template."""
    if kind == PLAIN:
        return w
    if kind == OPENED:
        return F.when(t == OPEN, NAME).otherwise(t)
    return F.when(t.isin([OPEN] if kind == NAMED else [OPEN, NAME]), w).otherwise(t)


def coded(df: DataFrame) -> DataFrame:
    """Rows with words w and their places p, and c0, c1 ...: a number for each word in each form.

    It is the word's hash, or the placeholder's own number where the form has one. All forms are
    made before windows are: code for it in each window would be too long to be compiled.
    """

    def code(last: int) -> Column:
        # A word that opens a sentence counts as a name in the last form.
        return F.zip_with("c0", "p", lambda c, p: F.when((p == 0) | (p > last), c).otherwise(F.least(p, F.lit(3).cast("long"))))

    df = df.withColumn("c0", F.transform("w", lambda w: F.xxhash64(w)))
    return df.withColumns({f"c{k}": code(last) for k, last in ((COUNTED, 2), (NAMED, 3), (OPENED, 4))})


def window_hash(kind: int, size: int) -> Column:
    """Hash of the window of a size at ``at`` in one form, from its words' numbers; null beyond the end."""
    return F.when(F.col("at") + size <= F.size("w"), F.xxhash64(*(at(f"c{kind}", i) for i in range(size))))


def windows(df: DataFrame, smallest: int) -> DataFrame:
    """A row for each place ``at`` of coded rows where a window of the smallest size begins.

    Only places are unrolled and hashes taken by place, so that hashing a window and
    probing the join stay in generated code.
    """
    n = F.size("w") - smallest + 1
    return df.withColumn("at", F.explode_outer(F.when(n > 0, F.sequence(F.lit(0), n - 1)))).filter(F.col("at").isNotNull())


def literals(t: Column) -> Column:
    """How many words of a template are no placeholders; a word that opens a sentence may be a name."""
    return F.size(F.filter(t, lambda x: ~x.isin(NUMBER, NAME, UNIT, OPEN)))


def items_of(benchmark: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), text.alias("text"), words(text).alias("w"), template(text).alias("t"), places(text).alias("p"))


def too_short(benchmark: DataFrame) -> DataFrame:
    """item_id and text of the items that say too little to be recognised."""
    return items_of(benchmark).filter(literals(F.col("t")) < LITERALS).select("item_id", "text")


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """item_id, n_windows, size, item_at, form, window, item_words, item_template for each form of each window of each item."""
    items = items_of(benchmark).filter(literals(F.col("t")) >= LITERALS)
    items = items.withColumn("size", F.least(F.lit(window), F.size("t"))).withColumn("n_windows", F.size("t") - F.col("size") + 1).checkpoint()
    # A capitalised first word is a word in the item and a name in a document that puts it after another word.
    opens = items.filter(F.regexp_like(F.trim("text"), F.lit(r"^\p{Lu}\p{L}*+(?![\p{N}])")))
    opens = opens.withColumns({"w": F.slice("w", F.lit(1), F.col("size")), "t": F.concat(F.array(F.lit(NAME)), F.slice("t", F.lit(2), F.col("size") - 1)), "p": F.concat(F.array(F.lit(3).cast("long")), F.slice("p", F.lit(2), F.col("size") - 1))})
    items = coded(items.withColumn("head", F.lit(False)).unionByName(opens.withColumn("head", F.lit(True))))
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())  # at most the window's size

    def sized(k: int) -> DataFrame:
        each = windows(items.filter(F.col("size") == k), k)
        forms = F.array(*(F.struct(F.lit(kind).alias("form"), window_hash(kind, k).alias("window"), F.array(*(form(kind, at("w", i), at("t", i)) for i in range(k))).alias("item_template")) for kind in KINDS))
        each = each.select("item_id", "n_windows", "size", "head", F.col("at").alias("item_at"), F.array(*(at("w", i) for i in range(k))).alias("item_words"), F.inline(forms))
        return each.filter(~F.col("head") | (F.col("form") == NAMED)).drop("head")

    return reduce(DataFrame.unionByName, map(sized, sizes or [window]))


def hashes(size: int) -> Column:
    """The distinct ones of a window's hashes as an array; where all are equal, without a search for the others."""
    columns = [F.col(f"h{size}_{k}") for k in KINDS]
    same = reduce(Column.__and__, [a == b for a, b in pairwise(columns)])
    return F.when(columns[0].isNull(), F.array().cast("array<bigint>")).when(same, F.array(columns[0])).otherwise(F.array_distinct(F.array(*columns)))


def meetings(rows: DataFrame, items: DataFrame, sizes: list[int], bounded: bool) -> DataFrame:
    """Each window of rows (doc_id, text_hash, w, p) that an item has in the same form."""

    def hashed(carried: list[str]) -> DataFrame:
        each = windows(coded(rows), sizes[0]).withColumns({f"h{s}_{k}": window_hash(k, s) for s in sizes for k in KINDS})
        probes = hashes(sizes[0]) if len(sizes) == 1 else F.concat(*map(hashes, sizes))
        each = each.withColumn("window", F.explode_outer(probes))
        return each.select("doc_id", "text_hash", "at", "window", *carried, *(f"h{s}_{k}" for s in sizes for k in KINDS))

    def same(row: DataFrame) -> DataFrame:
        return row.filter(reduce(Column.__or__, [(F.col("size") == s) & (F.col("form") == k) & (F.col("window") == F.col(f"h{s}_{k}")) for s in sizes for k in KINDS]))

    if bounded:
        return same(hashed(["w"]).join(F.broadcast(items), "window")).withColumn("doc_words", F.slice("w", F.col("at") + 1, F.col("size")))
    # Hashes alone are exchanged; words are taken again, of documents that meet an item.
    met = same(hashed([]).join(items.select("window", "form", "size", "item_id", "item_at"), "window"))
    met = met.select("doc_id", "text_hash", "at", "form", "size", "item_id", "item_at", "window").distinct().checkpoint()
    key = [F.col(f"r.{c}").eqNullSafe(F.col(f"m.{c}")) for c in ("doc_id", "text_hash")]
    found = rows.select("doc_id", "text_hash", "w").dropDuplicates(["doc_id", "text_hash"]).alias("r").join(met.alias("m"), key).select("m.*", F.slice("r.w", F.col("m.at") + 1, F.col("m.size")).alias("doc_words"))
    return found.join(items, ["window", "form", "size", "item_id", "item_at"])


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """Pairs of document and item: doc_id, text_hash, item_id, n_windows, n_matched, coverage, n_slots, same_values."""
    spark = docs.sparkSession
    prepare(spark)
    items = item_windows(benchmark, window).checkpoint()
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())  # at most the window's size
    if not sizes:
        return spark.createDataFrame([], "doc_id long, text_hash long, item_id long, n_windows int, n_matched int, coverage double, n_slots int, same_values boolean")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"), places(F.col("text")).alias("p"))
    met = meetings(rows, items, sizes, items.count() <= BROADCAST_WINDOWS)
    slots = F.filter(F.arrays_zip(F.col("item_template").alias("type"), F.col("item_words").alias("item"), F.col("doc_words").alias("doc")), lambda x: x["type"].isin(NUMBER, NAME, UNIT))
    no_name = F.exists(slots, lambda x: (x["type"] == NAME) & (x["item"] != x["doc"]) & (x["item"].isin(OPENERS) | x["doc"].isin(OPENERS)))
    head = (F.col("item_at") > 0) | (F.col("form") == OPENED) | (F.get("item_template", F.lit(0)) != NAME) | (F.get("item_words", F.lit(0)) == F.get("doc_words", F.lit(0)))
    # A flag, since a filter would be pushed to the join and leave generated code with whole documents in each row.
    counts = head & ((F.col("form") != OPENED) | (~no_name & (F.size(slots) < F.size("item_template"))))
    pair = ["doc_id", "text_hash", "item_id", "n_windows"]
    found = met.select(*pair, "form", "item_at", (F.col("at") - F.col("item_at")).alias("offset"), slots.alias("slots"), counts.alias("counts"))
    # One alignment has a row for each form of each window of its item at most.
    aligned = found.groupBy(*pair, "offset", "form").agg(F.collect_set(F.when(F.col("counts"), F.col("item_at"))).alias("at"), F.array_distinct(F.flatten(F.collect_set(F.when(F.col("counts"), F.col("slots"))))).alias("slots"))
    keys = lambda xs: F.array_distinct(F.transform(xs, lambda x: F.struct(x["type"], x["item"])))
    aligned = aligned.filter((F.size("at") > 0) & (F.size("slots") == F.size(keys(F.col("slots")))))
    ranked = aligned.groupBy(*pair).agg(F.array_sort(F.collect_list(F.struct((-F.size("at")).alias("rank"), "offset", "form", "slots", "at"))).alias("found"))
    # The first alignment with an item's value gives its counterpart; keys and slots are those of one item.
    all_slots = F.flatten(F.transform("found", lambda a: a["slots"]))
    given = ranked.withColumn("all", all_slots).withColumn("given", F.transform(keys(F.col("all")), lambda k: F.get(F.filter("all", lambda x: (x["type"] == k["type"]) & (x["item"] == k["item"])), F.lit(0))))
    agreed = given.withColumn("agreed", F.filter("found", lambda a: F.forall(a["slots"], lambda x: F.array_contains(F.col("given"), x))))
    kept = F.array_distinct(F.flatten(F.transform("agreed", lambda a: a["slots"])))
    each = agreed.select(*pair, F.size(F.array_distinct(F.flatten(F.transform("agreed", lambda a: a["at"])))).alias("n_matched"), kept.alias("kept"))
    each = each.withColumns({"coverage": F.col("n_matched") / F.col("n_windows"), "n_slots": F.size("kept"), "same_values": F.forall("kept", lambda x: x["item"] == x["doc"])})
    return each.filter(F.col("coverage") >= coverage).select(*pair, "n_matched", "coverage", "n_slots", "same_values")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """The documents that leak no item, with all their columns."""
    bad = leaks(docs, benchmark, window, coverage).select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct().checkpoint()
    right = F.broadcast(bad) if bad.count() <= BROADCAST_ROWS else bad
    text_hash = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = packed(docs, F.col("doc_id").cast("long").alias("id"), text_hash.alias("hash"))
    kept = rows.join(right, F.col("id").eqNullSafe(F.col("bad_id")) & (F.col("hash") == F.col("bad_hash")), "left_anti")
    return unpacked(kept, docs.columns)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leak of a benchmark item into a document."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")
