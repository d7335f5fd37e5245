"""Personal data: patterns propose, checksums confirm, context adjusts.

DataFrame functions only. For each kind a pattern proposes spans, leftmost and
without overlap; a validator (octets, Luhn, digit counts, ISO 7064 mod-97)
confirms or drops them. A span's score is that of its kind, raised if a word that
goes with the kind stands within ``BEFORE`` characters before it or ``AFTER`` after it
(up to the kind's next match). The four base kinds always stay; of the kinds added
here (IBANs, secrets, short card numbers) those that score ``THRESHOLD`` stay. An IBAN
or a short card number may be followed by more groups of capitals or digits: it ends at
the group where its checksum holds, an IBAN at its country's length if it holds there,
else at the last one.

Java's matcher recurses on repeated groups, so a very long run would overflow
its stack. Separators inside runs are therefore first replaced one for one by
private-use characters (those of the text give way to another), which makes
each run one character class. Positions are code points and stay as they were.
Spans come from the running lengths of a text's pieces and are replaced within its
blocks, so that time doesn't grow with the square of a text's length or spans.

Null and empty texts have no spans, an empty table gives no rows. Repeated rows get
equal results, other columns pass through, whatever their names; a column
named personal_data is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sokhan.llm.common import table

KINDS = ("email", "ip", "card", "phone", "iban", "secret", "short_card")
BASE = KINDS[:4]
BEFORE, AFTER, THRESHOLD = 40, 20, 0.5
#: Characters that a position is looked up among; matches that may stand within BEFORE characters.
BLOCK, NEAR = 512, 8
#: Score of a confirmed span, and the words near it that raise the score by 0.3.
SCORES = {"email": 0.7, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.7, "secret": 0.6, "short_card": 0.3}
WORDS = {
    "email": "e-?mail|mail|contact|write",
    "ip": "ip|host|server|address",
    "card": "card|visa|mastercard|credit|debit|payment",
    "phone": "phone|tel|call|mobile|fax",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "secret": "login|user|key|config",
    "short_card": "card|amex|diners|credit|debit|account",
}
#: Characters of an IBAN by country; for others any length that passes.
IBAN_LENGTHS = {
    **dict.fromkeys("NO".split(), 15),
    **dict.fromkeys("BE BI".split(), 16),
    **dict.fromkeys("DK FI FK FO GL NL SD".split(), 18),
    **dict.fromkeys("MK SI".split(), 19),
    **dict.fromkeys("AT BA EE KZ LT LU MN XK".split(), 20),
    **dict.fromkeys("CH CR HR LI LV".split(), 21),
    **dict.fromkeys("BG BH DE GB GE IE ME RS VA".split(), 22),
    **dict.fromkeys("AE GI IL IQ OM SO TL".split(), 23),
    **dict.fromkeys("AD CZ ES MD PK RO SA SE SK TN VG".split(), 24),
    **dict.fromkeys("LY PT ST".split(), 25),
    **dict.fromkeys("IS TR".split(), 26),
    **dict.fromkeys("DJ FR GR IT MC MR SM".split(), 27),
    **dict.fromkeys("AL AZ BY CY DO GT HU LB NI PL SV".split(), 28),
    **dict.fromkeys("BR EG PS QA UA".split(), 29),
    **dict.fromkeys("JO KW MU".split(), 30),
    **dict.fromkeys("MT SC".split(), 31),
    "LC": 32,
    "RU": 33,
}
GAP, DOT, OTHER = "\ue000", "\ue001", "\ue002"
SPAN = "struct<kind:string,start:long,end:long,found:string,before:string,after:string>"
EMPTY = f"array<{SPAN}>"


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """fn(value), with value evaluated once however often fn uses it."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """What join makes from 0 of all longs before each place, in two steps over chunks.

    An aggregate's state is copied at each element, so it can't be an array that grows.
    """
    zero = F.lit(0).cast("long")

    def run(v: Column, c: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / c).cast("int")), lambda j: F.aggregate(F.slice(v, j * c + 1, c), zero, join))
        first = let(sums, lambda ss: F.transform(ss, lambda x, j: F.aggregate(F.slice(ss, F.lit(1), j), zero, join)))
        return let(first, lambda begin: F.transform(v, lambda x, i: F.aggregate(F.slice(v, i - i % c + 1, i % c), F.get(begin, F.floor(i / c).cast("int")), join)))

    def sized(v: Column) -> Column:
        return F.when(F.size(v) > 0, let(F.ceil(F.cbrt(F.size(v))).cast("int"), lambda c: run(v, c))).otherwise(F.array().cast("array<bigint>"))

    return let(values, sized)


def proposals(kind: str, text: Column, pattern: str) -> Column:
    """The pattern's matches as structs; pieces between them give the positions and what stands near."""

    def spans(found: Column) -> Column:
        def run(pieces: Column) -> Column:
            pairs = F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda p, f: F.array(p, f))
            sizes = F.transform(pairs, lambda x: (F.length(x[0]) + F.length(x[1])).cast("long"))
            ends = F.transform(F.flatten(pairs), lambda x: F.right(x, F.lit(BEFORE)))

            def span(begin: Column, tails: Column, f: Column, i: Column) -> Column:
                start, last = begin + F.length(F.get(pieces, i)), F.least(i, F.lit(NEAR))
                before = F.array_join(F.slice(tails, 2 * (i - last) + 1, 2 * last + 1), "")
                return F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(f)).alias("end"), f.alias("found"), F.right(before, F.lit(BEFORE)).alias("before"), F.left(F.get(pieces, i + 1), F.lit(AFTER)).alias("after"))

            return let(running(sizes, lambda a, b: a + b), lambda begins: let(ends, lambda tails: F.transform(found, lambda f, i: span(F.get(begins, i), tails, f, i))))

        return F.when(F.size(found) > 0, let(F.split(text, pattern, -1), run)).otherwise(F.array().cast(EMPTY))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Whether a string of digits passes: every second digit from the right doubled."""

    def add(acc: Column, i: Column) -> Column:
        x = F.substring(d, F.length(d) - i + 1, F.lit(1)).cast("int")
        twice = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return acc + F.when(i % 2 == 0, twice).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0


def mod97(s: Column) -> Column:
    """ISO 7064: the first four characters go to the end, letters count from 10."""
    turned = F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, F.lit(1), F.lit(4)))

    def add(acc: Column, c: Column) -> Column:
        v = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
        return F.when(v < 10, acc * 10 + v).otherwise(acc * 100 + v) % 97

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), add) == 1


def ended(x: Column, found: Column, end: Column) -> Column:
    """A span of the first so many characters of found."""
    return F.struct(x["kind"].alias("kind"), x["start"].alias("start"), (x["start"] + end).alias("end"), F.substring(found, F.lit(1), end).alias("found"), x["before"].alias("before"), x["after"].alias("after"))


def ibans(text: Column) -> Column:
    """Confirmed IBANs: heads propose starts, also within what follows another; one that starts within an earlier one goes."""
    head = "(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}"
    heads = proposals("iban", text, head + "(?= ?[A-Z0-9])")
    # 30 characters at most, a blank before any, and the one after.
    rests = F.regexp_extract_all(text, F.lit(head + "(?=( ?[A-Z0-9][A-Za-z0-9 ]{0,62}))"), F.lit(1))
    lengths = F.create_map(*(F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair))

    def compact(s: Column) -> Column:
        return F.regexp_replace(s, " ", "")

    def whole(x: Column, rest: Column) -> Column:
        piece = F.concat(x["found"], rest)
        run = F.regexp_extract(piece, "^[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}", 0)

        def good(e: Column) -> Column:
            last, after, found = F.substring(run, e, F.lit(1)), F.substring(piece, e + 1, F.lit(1)), compact(F.substring(run, F.lit(1), e))
            return (last != " ") & ~F.regexp_like(after, F.lit("[A-Za-z0-9]")) & (F.length(found) >= 15) & mod97(found)

        ends = F.when(F.length(run) >= 15, F.filter(F.sequence(F.lit(15), F.length(run)), good)).otherwise(F.array().cast("array<int>"))
        own = F.filter(ends, lambda e: F.length(compact(F.substring(run, F.lit(1), e))) == F.try_element_at(lengths, F.substring(run, F.lit(1), F.lit(2))))
        return ended(x, run, F.coalesce(F.array_max(own), F.array_max(ends)))

    def apart(found: Column) -> Column:
        reach = running(F.transform(found, lambda x: x["end"]), lambda a, b: F.greatest(a, b))
        return let(reach, lambda r: F.filter(found, lambda x, i: x["start"] >= F.get(r, i)))

    return let(F.filter(F.zip_with(heads, rests, whole), lambda x: x["end"].isNotNull()), apart)


def short_cards(gaps: Column, low: int = 13, high: int = 15) -> Column:
    """Confirmed runs of so many digits, whole or the leading groups of a run that is no card itself."""
    runs = proposals("short_card", gaps, f"(?<!{RUN}){RUN}{{{low},}}+")

    def end(x: Column) -> Column:
        def good(e: Column) -> Column:
            d = digits(F.substring(x["found"], F.lit(1), e))
            return F.substring(x["found"], e + 1, F.lit(1)).isin("", GAP) & F.length(d).between(low, high) & luhn(d)

        return F.array_max(F.filter(F.sequence(F.lit(low), F.least(F.length(x["found"]), F.lit(2 * high - 1))), good))

    def card(x: Column) -> Column:
        d = digits(x["found"])
        return F.length(d).between(16, 19) & luhn(d)

    found = F.transform(F.filter(runs, lambda x: ~card(x)), lambda x: ended(x, x["found"], end(x)))
    return F.filter(found, lambda x: x["end"].isNotNull())


OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
RUN = f"[0-9{GAP}]"
LOCAL = f"[A-Za-z0-9._%+{DOT}-]"
LABEL = f"[A-Za-z0-9{DOT}-]"


def confirmed(text: Column) -> dict[str, Column]:
    """Confirmed spans of each kind as an array column."""
    none = F.array().cast(EMPTY)
    clear = F.translate(text, GAP + DOT, OTHER * 2)
    gaps = F.regexp_replace(clear, "(?<=[0-9])[ -](?=[0-9])", GAP)
    dots = F.regexp_replace(clear, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", DOT)
    long_run = text.rlike("[0-9](?:[ -]?[0-9]){12}")

    def run(kind: str, low: int, high: int) -> Column:
        # Runs as a whole, longest with a separator between any two digits.
        spans = proposals(kind, gaps, f"(?<!{RUN}){RUN}{{{low},{2 * high - 1}}}(?!{RUN})")
        return F.when(long_run, F.filter(spans, lambda x: F.length(digits(x["found"])).between(low, high) & luhn(digits(x["found"])))).otherwise(none)

    return {
        # A match starts where its run of local characters does, or where the match before ended.
        "email": F.when(F.instr(text, "@") > 0, proposals("email", dots, rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++{DOT}{LABEL}++")).otherwise(none),
        "ip": F.when(text.rlike(r"[0-9]\.[0-9]"), F.filter(proposals("ip", text, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"), lambda x: x["found"].rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))).otherwise(none),
        "card": run("card", 16, 19),
        "phone": F.when(F.instr(text, "+") > 0, F.filter(proposals("phone", text, r"\+[0-9][ ().0-9-]+[0-9]"), lambda x: F.length(digits(x["found"])).between(8, 15))).otherwise(none),
        "iban": F.when(text.rlike("[A-Z]{2}[0-9]{2} ?[A-Z0-9]"), ibans(text)).otherwise(none),
        "secret": F.when(text.rlike("(?i)password|passwd|secret|token|api[_-]?key|AKIA"), proposals("secret", text, r"(?i)\b(?:password|passwd|secret|token|api[_-]?key)[\"']?\s{0,3}[:=]\s{0,3}[\"']?[A-Za-z0-9_+/=-]{8,}|\bAKIA[A-Z0-9]{16}\b")).otherwise(none),
        "short_card": F.when(long_run, short_cards(gaps)).otherwise(none),
    }


def scored(spans: Column) -> Column:
    """Spans with their score; the words of a kind near a span raise it."""
    words = F.create_map(*(F.lit(x) for k in KINDS for x in (k, rf"(?i)(?<![a-z])(?:{WORDS[k]})(?![a-z])")))
    base = F.create_map(*(F.lit(x) for k in KINDS for x in (k, SCORES[k])))

    def add(x: Column) -> Column:
        near = F.regexp_like(x["before"], words[x["kind"]]) | F.regexp_like(x["after"], words[x["kind"]])
        score = base[x["kind"]] + F.when(near, 0.3).otherwise(0.0)
        return F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), score.alias("score"))

    return F.transform(spans, add)


def personal_data(text: Column) -> Column:
    """An array of (kind, start, end, score) by kind, then start."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    keep = lambda x: x["kind"].isin(*BASE) | (x["score"] >= THRESHOLD)
    none = F.array().cast("array<struct<kind:string,start:long,end:long,score:double>>")
    return let(F.concat(*confirmed(text).values()), lambda spans: F.when(F.size(spans) > 0, F.filter(scored(spans), keep)).otherwise(none))


def find_personal_data(df: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns and personal_data, an array of (kind, start, end, score) by kind, then start."""
    return df.withColumn("personal_data", personal_data(F.col(text_col)))


def replaced(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; overlapping spans become one."""
    order = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("neg"), F.concat(F.lit("<"), F.upper(x["kind"]), F.lit(">")).alias("kind"))))

    def run(blocks: Column, marks: Column) -> Column:
        def between(a: Column, b: Column) -> Column:
            """Characters from a to before b, from the blocks they lie in."""
            first, last = (F.floor(x / BLOCK).cast("int") for x in (a, b))
            part = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
            return F.when(a < b, F.substring(part, (a - first * BLOCK + 1).cast("int"), (b - a).cast("int"))).otherwise(F.lit(""))

        def part(at: Column, x: Column) -> Column:
            return F.when(x["start"] >= at, F.concat(between(at, x["start"]), x["kind"])).otherwise(F.lit(""))

        reach = running(F.transform(marks, lambda x: -x["neg"]), lambda a, b: F.greatest(a, b))
        return let(reach, lambda r: F.array_join(F.transform(marks, lambda x, i: part(F.get(r, i), x)), ""))

    end = F.struct(F.length(text).cast("long").alias("start"), F.lit(0).cast("long").alias("neg"), F.lit("").alias("kind"))
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    return let(blocks, lambda bs: let(F.concat(order, F.array(end)), lambda marks: run(bs, marks)))


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The text with each span replaced by its kind in angle brackets; overlapping spans become one."""
    text = F.col(text_col).cast("string")
    clean = let(personal_data(text), lambda spans: F.when(F.size(spans) > 0, replaced(text, spans)).otherwise(text))
    return df.withColumn(text_col, clean)


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, checksum of the base spans, and all spans of every document."""
    out = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("personal_data", lambda x: x["kind"].isin(*BASE))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("personal_data", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select("doc_id", *map(count, BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("personal_data")).alias("spans"))
